"""Scoring documents with an n-gram model in an Elias-Fano trie."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirespark.llm.common import lower_ascii, numbered, spans, split_words, stored, word_hashes
from wirespark.llm.token_files import mapped, open_folder
from wirespark.llm.token_ids import blocks

#: Words of the longest n-gram, least count of an n-gram of two or more words that is kept
#: unless the caller says otherwise (the query keeps all), what is taken off each count for
#: words not seen after a context.
ORDER, MIN_COUNT, DISCOUNT = 3, 2, 0.75
#: What the base score adds to each count.
ADDED = 0.1

_END = np.uint64(xxhash.xxh3_64_intdigest(b"\n"))
#: n-grams that a task holds before it sums them up.
_HELD = 2_000_000
#: A row for each block of documents: their tokens as numbers into the block's word hashes.
_BLOCKS = (
    "doc_ids array<bigint>, held_out array<boolean>, sizes binary, hashes binary, tokens binary"
)
#: A block is a row of megabytes: a few rows make a row group, so tasks hold only a few.
_FEW_ROWS = {
    "parquet.block.size": str(8 << 20),
    "parquet.page.size.row.check.min": "1",
    "parquet.enable.dictionary": "false",
    "compression": "zstd",
}
_BLOBS = "bucket int, contexts binary, words binary, counts binary"
_SHARDS = (
    "bucket int, name string, entries bigint, total bigint, once bigint, "
    "first_context bigint, first_word bigint"
)
_SCORES = (
    "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
    "base_score double, score double"
)


# Compact sequences ------------------------------------------------------------------------


def pack_bits(values: np.ndarray, width: int) -> np.ndarray:
    """Numbers of ``width`` bits, one after another in 64-bit words (one spare at the end)."""
    words = np.zeros(len(values) * width // 64 + 2, np.uint64)
    if width:
        bit = np.arange(len(values), dtype=np.int64) * width
        word, shift = bit >> 6, (bit & 63).astype(np.uint64)
        values = values.astype(np.uint64)
        np.bitwise_or.at(words, word, values << shift)
        over = shift + np.uint64(width) > np.uint64(64)
        np.bitwise_or.at(words, word[over] + 1, values[over] >> (np.uint64(64) - shift[over]))
    return words


def unpack_bits(words: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    if not width:
        return np.zeros(len(at), np.uint64)
    bit = at.astype(np.int64, copy=False) * width
    word, shift = bit >> 6, (bit & 63).view(np.uint64)
    # In two steps, since a shift by 64 is not defined: nothing is taken where ``shift`` is 0.
    high = (words[word + 1] << np.uint64(1)) << (shift ^ np.uint64(63))
    return ((words[word] >> shift) | high) & np.uint64((1 << width) - 1)


_ONES, _TOPS = np.uint64(0x0101010101010101), np.uint64(0x8080808080808080)
#: Place of the nth set bit of each byte.
_IN_BYTE = np.zeros((256, 8), np.uint8)
for _byte in range(256):
    for _nth, _place in enumerate([i for i in range(8) if _byte >> i & 1]):
        _IN_BYTE[_byte, _nth] = _place


def _select_in_word(words: np.ndarray, nth: np.ndarray) -> np.ndarray:
    """Place of the nth (from 0) set bit of each word: its byte by running counts, then a table."""
    nth = nth.astype(np.uint64)
    counts = np.bitwise_count(np.ascontiguousarray(words).view(np.uint8)).view(np.uint64)
    upto = counts * _ONES  # byte by byte, the set bits up to its end
    fewer = (((nth * _ONES) | _TOPS) - upto) & _TOPS
    place = np.bitwise_count(fewer).astype(np.uint64) << np.uint64(3)
    rest = nth - (((upto << np.uint64(8)) >> place) & np.uint64(255))
    byte = (words >> place) & np.uint64(255)
    return place.astype(np.int64) + _IN_BYTE[byte.astype(np.int64), rest.astype(np.int64)]


class EliasFano:
    """A rising sequence: low bits packed, high bits in unary, with the ones before each word."""

    FILES = ("meta", "low", "high", "ones")

    def __init__(self, meta, low, high, ones):
        self.size, self.width = int(meta[0]), int(meta[1])
        self.low, self.high, self.ones = low, high, ones
        self.zeros = np.arange(len(ones), dtype=np.int64) * 64 - ones.astype(np.int64)

    @classmethod
    def arrays(cls, values: np.ndarray, limit: int) -> tuple[np.ndarray, ...]:
        values = values.astype(np.uint64)
        size = len(values)
        width = max(0, (int(limit) // max(size, 1)).bit_length() - 1)
        up = (values >> np.uint64(width)).astype(np.int64)
        bits = up + np.arange(size)
        high = np.zeros((int(limit) >> width) // 64 + size // 64 + 3, np.uint64)
        np.bitwise_or.at(high, bits >> 6, np.uint64(1) << (bits & 63).astype(np.uint64))
        ones = np.concatenate([[0], np.cumsum(np.bitwise_count(high).astype(np.int64))[:-1]])
        low = pack_bits(values & np.uint64((1 << width) - 1), width)
        return np.array([size, width], np.int64), low, high, ones

    def get(self, at: np.ndarray) -> np.ndarray:
        """The values at the given places."""
        word = np.searchsorted(self.ones, at, side="right") - 1
        bit = _select_in_word(self.high[word], at - self.ones[word])
        up = (word * 64 + bit - at).astype(np.uint64)
        return (up << np.uint64(self.width)) | unpack_bits(self.low, at, self.width)

    def values(self) -> np.ndarray:
        """The whole sequence."""
        at = np.arange(self.size)
        bits = np.flatnonzero(np.unpackbits(self.high.view(np.uint8), bitorder="little"))
        up = (bits - at).astype(np.uint64)
        return (up << np.uint64(self.width)) | unpack_bits(self.low, at, self.width)

    def _begin(self, up: np.ndarray) -> np.ndarray:
        """Values whose high part is below ``up``: the zeros select the place."""
        nth = up - 1
        word = np.searchsorted(self.zeros, np.maximum(nth, 0), side="right") - 1
        bit = _select_in_word(~self.high[word], np.maximum(nth, 0) - self.zeros[word])
        return np.where(up > 0, word * 64 + bit - nth, 0)

    def find(self, values: np.ndarray) -> np.ndarray:
        """Place of each value, -1 if it isn't there."""
        if not self.size:
            return np.full(len(values), -1, np.int64)
        up = (values >> np.uint64(self.width)).astype(np.int64)
        want = values & np.uint64((1 << self.width) - 1)
        low, end = self._begin(up), self._begin(up + 1)
        return _search(lambda at: unpack_bits(self.low, at, self.width), want, low, end)


def _search(read, want: np.ndarray, low: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The last value not above each wanted one in its own rising range; its place if equal, else -1.

    Ranges of one value, which most are, take no step.
    """
    low = low.copy()
    rows = np.flatnonzero(end - low > 1)
    first, last, sought = low[rows], end[rows], want[rows]
    while len(rows):
        middle = (first + last) >> 1
        reached = read(middle) <= sought
        first, last = np.where(reached, middle, first), np.where(reached, last, middle)
        wide = last - first > 1
        low[rows[~wide]] = first[~wide]
        rows, first, last, sought = rows[wide], first[wide], last[wide], sought[wide]
    inside = np.flatnonzero(low < end)
    found = np.full(len(want), -1, np.int64)
    equal = inside[read(low[inside]) == want[inside]]
    found[equal] = low[equal]
    return found


def _quantised(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A code of one byte for each value, and the values that codes stand for."""
    book = np.zeros(1)
    if len(values):  # half of the steps follow the values, half their range
        even = np.linspace(values.min(), values.max(), 128)
        book = np.unique(np.append(np.quantile(values, np.linspace(0, 1, 128)), even))
    at = np.clip(np.searchsorted(book, values), 1, max(len(book) - 1, 1))
    at = np.minimum(at, len(book) - 1)
    nearer = np.abs(values - book[np.maximum(at - 1, 0)]) <= np.abs(values - book[at])
    return np.where(nearer, np.maximum(at - 1, 0), at).astype(np.uint8), book


def narrow(values: np.ndarray) -> np.ndarray:
    """The same numbers (none below 0) in as few bytes each as the largest needs."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    return values.astype(kind.newbyteorder("<"))


def _squeezed(values: np.ndarray, rising: bool) -> bytes:
    """Numbers as bytes; rising ones by their steps, behind the width and the first.

    All lowest bytes come first, then the next ones: the higher ones are mostly 0 and compress.
    """
    first = values[:1] if rising else np.zeros(1, values.dtype)
    steps = narrow(np.diff(values, prepend=first) if rising else values)
    planes = steps.view("u1").reshape(-1, steps.itemsize).T
    return np.array([steps.itemsize, first[0]], "<u8").tobytes() + planes.tobytes()


def _spread(blob: bytes, rising: bool, kind: type) -> np.ndarray:
    width, first = np.frombuffer(blob, "<u8", 2)
    planes = np.frombuffer(blob, "u1", offset=16).reshape(int(width), -1)
    steps = np.ascontiguousarray(planes.T).view(f"<u{width}").ravel().astype(kind)
    return np.cumsum(steps) + kind(first) if rising else steps


# The trie ---------------------------------------------------------------------------------


class Shard:
    """A range of one level's entries, memory-mapped file by file as needed."""

    KINDS = {"meta": "<i8", "ones": "<i8", "codes": "u1", "book": "<f8",
             "backs": "u1", "back_book": "<f8"}
    #: Numbers of a width of their own, which stands in the first of eight bytes before them.
    NARROW = ("counts",)

    def __init__(self, folder: str, level: int, row: dict):
        self.store, root = open_folder(folder)
        self.stem, self.row, self.held = f"{root}/{level}-{row['name']}", row, {}

    def array(self, what: str) -> np.ndarray:
        if what not in self.held and what in self.NARROW:
            raw = np.asarray(mapped(self.store, f"{self.stem}-{what}.bin", "u1"))
            self.held[what] = raw[8:].view(f"<u{raw[0]}" if raw[0] < 8 else "<i8")
        elif what not in self.held:
            kind = self.KINDS.get(what.rpartition(".")[2], "<u8")
            # As a plain array: each slice of a memmap object costs more than reading it.
            self.held[what] = np.asarray(mapped(self.store, f"{self.stem}-{what}.bin", kind))
        return self.held[what]

    def powers(self, book: str) -> np.ndarray:
        """Ten to the values that codes stand for."""
        if book + "^" not in self.held:
            self.held[book + "^"] = 10 ** self.array(book).astype(float)
        return self.held[book + "^"]

    def sequence(self, what: str) -> EliasFano:
        if what + "!" not in self.held:
            self.held[what + "!"] = EliasFano(
                *[self.array(f"{what}.{part}") for part in EliasFano.FILES]
            )
        return self.held[what + "!"]

    def write(self, **arrays: np.ndarray) -> None:
        for what, values in arrays.items():
            with self.store.open_output_stream(f"{self.stem}-{what}.bin") as file:
                if what in self.NARROW:
                    values = narrow(values)
                    file.write(np.array([values.itemsize], "<u8").tobytes())
                file.write(np.ascontiguousarray(values).tobytes())

    def write_sequence(self, what: str, values: np.ndarray, limit: int) -> None:
        parts = EliasFano.arrays(values, limit)
        self.write(**{f"{what}.{k}": v for k, v in zip(EliasFano.FILES, parts)})


class Level:
    """All shards of a level in order; an entry's number is its place in that order."""

    def __init__(self, folder: str, level: int, rows: list[dict], words: int):
        self.level, self.rows = level, rows
        self.shards = [Shard(folder, level, row) for row in rows]
        self.bases = np.cumsum([0, *[row["entries"] for row in rows]])
        self.total = sum(row["total"] for row in rows)
        self.width = max(1, int(words).bit_length())
        self.firsts = [(row["first_context"], row["first_word"]) for row in rows]

    def _parts(self, owner: np.ndarray):
        """Queries by shard; of those in order, slices."""
        if (owner[1:] >= owner[:-1]).all():
            cuts = np.flatnonzero(np.diff(owner, prepend=-1))
            for begin, end in zip(cuts, np.append(cuts[1:], len(owner))):
                yield int(owner[begin]), slice(int(begin), int(end))
            return
        if len(self.rows) < 1 << 15:  # short numbers get a radix sort
            owner = owner.astype(np.int16)
        order = np.argsort(owner, kind="stable")
        cuts = np.flatnonzero(np.diff(owner[order], prepend=-1))
        for begin, end in zip(cuts, np.append(cuts[1:], len(order))):
            yield int(owner[order[begin]]), order[begin:end]

    def _owner(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bases, at, side="right") - 1

    def read(self, at: np.ndarray, codes: str, kind: type = float) -> np.ndarray:
        """Stored values of the entries ``at``."""
        out = np.zeros(len(at), kind)
        for shard, rows in self._parts(self._owner(at)):
            out[rows] = self.shards[shard].array(codes)[at[rows] - self.bases[shard]]
        return out

    def powers(self, at: np.ndarray, codes: str, book: str) -> np.ndarray:
        """Ten to the decoded values of the entries ``at``; the book is raised, not each entry."""
        out = np.zeros(len(at))
        for shard, rows in self._parts(self._owner(at)):
            raised = self.shards[shard].powers(book)
            out[rows] = raised[self.shards[shard].array(codes)[at[rows] - self.bases[shard]]]
        return out

    def before(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count of each entry and of all entries before it."""
        counts, sums = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        starts = np.cumsum([0, *[row["total"] for row in self.rows]])
        for shard, rows in self._parts(self._owner(at)):
            own = self.shards[shard].array("counts")
            local = at[rows] - self.bases[shard]
            counts[rows] = own[local]
            sums[rows] = starts[shard] + np.cumsum(own, dtype=np.int64)[local] - own[local]
        return counts, sums

    def children(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the entries' children begin and end in the next level, by the pointers."""
        low, end = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for shard, rows in self._parts(self._owner(at)):
            local, pointers = at[rows] - self.bases[shard], self.shards[shard].sequence("pointers")
            base = int(self.shards[shard].array("pointer_base.meta")[0])
            low[rows] = base + pointers.get(local).astype(np.int64)
            end[rows] = base + pointers.get(local + 1).astype(np.int64)
        return low, end

    def find_words(self, hashes: np.ndarray) -> np.ndarray:
        """First level: entry of each word hash, -1 if unknown."""
        out = np.full(len(hashes), -1, np.int64)
        firsts = np.array([np.uint64(np.int64(w)) for _, w in self.firsts], np.uint64)
        owner = np.searchsorted(firsts, hashes, side="right") - 1
        for shard, rows in self._parts(owner):
            if shard >= 0:
                place = self.shards[shard].sequence("hashes").find(hashes[rows])
                out[rows] = np.where(place >= 0, place + self.bases[shard], -1)
        return out

    def find_children(
        self, contexts: np.ndarray, words: np.ndarray, low: np.ndarray, end: np.ndarray
    ) -> np.ndarray:
        """Higher levels: entry of each word within its context's children, -1 if none.

        The pairs come in order, so each shard gets a run of them.
        """
        out = np.full(len(words), -1, np.int64)
        begins = []
        for context, word in self.firsts:  # a context may go on in the next shards
            lo, hi = np.searchsorted(contexts, [context, context + 1])
            begins.append(lo + np.searchsorted(words[lo:hi], word))
        owner = np.searchsorted(begins, np.arange(len(words)), side="right") - 1
        for shard, rows in self._parts(owner):
            if shard < 0:
                continue
            packed, base = self.shards[shard].array("words"), self.bases[shard]
            begin = np.maximum(low[rows], base) - base
            stop = np.minimum(end[rows], self.bases[shard + 1]) - base
            place = _search(
                lambda at: unpack_bits(packed, at, self.width),
                words[rows].astype(np.uint64),
                begin,
                np.maximum(begin, stop),
            )
            out[rows] = np.where(place >= 0, place + base, -1)
        return out


class Trie:
    """The levels of a model folder."""

    def __init__(self, folder: str, levels: tuple):
        words = sum(row["entries"] for row in map(dict, levels[0]))
        self.levels = [
            Level(folder, n + 1, [dict(r) for r in rows], words) for n, rows in enumerate(levels)
        ]
        self.words, self.tokens = words, self.levels[0].total
        once = sum(row["once"] for row in self.levels[0].rows)
        self.unknown = (once + 1) / (self.tokens + 2)

    def grams(self, words: np.ndarray, place: np.ndarray, order: int):
        """Entries of the n-grams that end at each token, level by level up to ``order``.

        ``words``: word entries, -1 unknown; ``place``: tokens before it in the document, which
        begins with an end mark. Yields per level: contexts' entries, the n-grams' entries and, of
        n-grams of known words, the tokens they end at, which of the distinct ones each is, which
        of the distinct contexts each of these has, the contexts' entries and the n-grams', all
        in order.
        """
        entries = words
        yield None, entries, None
        for n in range(2, order + 1):
            contexts = np.full(len(words), -1, np.int64)
            contexts[1:] = entries[:-1]
            contexts[place < n - 1] = -1
            if n > len(self.levels):
                yield contexts, None, None
                return
            known = np.flatnonzero((contexts >= 0) & (words >= 0))
            entries = np.full(len(words), -1, np.int64)
            pairs, back = _distinct(contexts[known], words[known])
            fresh = np.diff(pairs[0], prepend=-1) > 0  # each context is looked up once
            nth = np.cumsum(fresh) - 1
            parents = pairs[0][fresh]
            low, end = (ends[nth] for ends in self.levels[n - 2].children(parents))
            some = np.flatnonzero(low < end)
            found = np.full(len(pairs[0]), -1, np.int64)
            found[some] = self.levels[n - 1].find_children(
                pairs[0][some], pairs[1][some], low[some], end[some]
            )
            entries[known] = found[back]
            yield contexts, entries, (known, back, nth, parents, found)


def _ordered(contexts: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Order by context, then word: by one key where both fit into 64 bits."""
    most = int(words.max(initial=0)) + 1
    if (int(contexts.max(initial=0)) + 1) * most < 1 << 64:
        return np.argsort(contexts.astype(np.uint64) * np.uint64(most) + words.astype(np.uint64))
    if not contexts.any():
        return np.argsort(words)
    return np.lexsort((words, contexts))


def _distinct(a: np.ndarray, b: np.ndarray):
    """Distinct pairs in order, and which of them each row is."""
    order = _ordered(a, b)
    a, b = a[order], b[order]
    fresh = np.ones(len(a), bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    back = np.empty(len(a), np.int64)
    back[order] = np.cumsum(fresh) - 1
    return (a[fresh], b[fresh]), back


@lru_cache(maxsize=2)
def _trie(folder: str, levels: tuple) -> Trie:
    return Trie(folder, levels)


def _frozen(rows: list) -> tuple:
    return tuple(tuple(row.asDict().items()) for row in rows)


# Training ---------------------------------------------------------------------------------


def _tokens(texts: pa.LargeStringArray):
    """Hashes of the different words, and each document as end mark, words, end mark.

    Returns the hashes, tokens as numbers into them (the last is the end), and each document's
    number of tokens.
    """
    bounds, words = split_words(lower_ascii(texts))
    numbers, different = numbered(words)
    hashes = np.append(word_hashes(different), _END)
    sizes = np.diff(bounds) + 2
    flat = np.full(int(sizes.sum()), len(hashes) - 1, np.int32)
    inner = np.ones(len(flat), bool)
    ends = np.cumsum(sizes)
    inner[ends - 1] = inner[ends - sizes] = False
    flat[inner] = numbers
    return hashes, flat, sizes


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of tokens of the texts."""
    for batch in batches:
        for begin, end, texts in blocks(batch.column("text")):
            hashes, flat, sizes = _tokens(texts)
            ends = pa.array([0, end - begin], pa.int32())
            columns = [
                pa.ListArray.from_arrays(ends, batch.column(c).slice(begin, end - begin))
                for c in ("doc_id", "held_out")
            ]
            for values in (sizes, hashes, flat):
                columns.append(pa.array([values.tobytes()], pa.binary()))
            names = ["doc_ids", "held_out", "sizes", "hashes", "tokens"]
            yield pa.RecordBatch.from_arrays(columns, names=names)


def _block(batch: pa.RecordBatch, row: int, trained: bool = False):
    """Hashes, tokens, each token's place in its document and its document, of a block.

    With ``trained`` the documents that are held out are left out.
    """
    sizes, hashes, flat = [
        np.frombuffer(batch.column(c)[row].as_buffer(), kind)
        for c, kind in (("sizes", "<i8"), ("hashes", "<u8"), ("tokens", "<i4"))
    ]
    if trained:
        kept = ~batch.column("held_out")[row].values.to_numpy(zero_copy_only=False)
        flat, sizes = flat[np.repeat(kept, sizes)], sizes[kept]
    return hashes, flat, spans(sizes), np.repeat(np.arange(len(sizes)), sizes)


def _merged(contexts: np.ndarray, words: np.ndarray, counts: np.ndarray):
    """Counts of equal n-grams summed up; sorted by context, then word."""
    order = _ordered(contexts, words)
    contexts, words, counts = contexts[order], words[order], counts[order]
    fresh = np.ones(len(words), bool)
    fresh[1:] = (contexts[1:] != contexts[:-1]) | (words[1:] != words[:-1])
    cuts = np.flatnonzero(fresh)
    return contexts[cuts], words[cuts], np.add.reduceat(counts, cuts) if len(cuts) else counts


def _summed(held: list):
    """Counts of a task, summed up and sorted."""
    return _merged(*[np.concatenate(x) for x in zip(*held)])


def _dealt(counted: tuple, trie: Trie | None, buckets: int) -> pa.RecordBatch:
    """Sorted counts, dealt to buckets that are ranges of (context, word) of equal weight."""
    contexts, words, counts = counted
    if trie is None:
        bucket = (words >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)
    else:
        level = trie.levels[-1]
        weight, before = level.before(contexts)
        share = (before + weight * (words / max(trie.words, 1))) / max(level.total, 1)
        bucket = np.minimum(share * buckets, buckets - 1)
    bucket = bucket.astype(np.int32)
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(cuts[1:], len(bucket))
    columns = [pa.array(bucket[cuts])]
    for values, rising in ((contexts, True), (words, False), (counts, False)):
        blobs = [_squeezed(values[a:b], rising) for a, b in zip(cuts, ends)]
        columns.append(pa.array(blobs, pa.binary()))
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "contexts", "words", "counts"])


def _counted(
    batches: Iterator[pa.RecordBatch], folder: str, levels: tuple, buckets: int, least: int
) -> Iterator[pa.RecordBatch]:
    """n-grams of the next level with their counts, summed per task.

    An n-gram can only be kept if its first and its last n-1 words are; others aren't counted.
    """
    trie, held, size = (_trie(folder, levels) if levels else None), [], 0
    for batch in batches:
        for row in range(batch.num_rows):
            hashes, flat, place, _ = _block(batch, row, trained=True)
            if trie is None:
                counts = np.bincount(flat[place > 0], minlength=len(hashes))
                met = np.flatnonzero(counts)  # others are words of documents held out
                held.append((np.zeros(len(met), np.int64), hashes[met], counts[met]))
            else:
                words = trie.levels[0].find_words(hashes)[flat]
                level = len(levels) + 1
                entries = None
                for contexts, found, _ in trie.grams(words, place, level):
                    entries, before = found, entries
                use = (contexts >= 0) & (words >= 0)
                if level > 2:
                    use &= before >= 0
                elif least > 1:  # words that are too rare themselves
                    many = trie.levels[0].read(np.maximum(words, 0), "counts", int)
                    use &= (many >= least) & (np.append(0, many[:-1]) >= least)
                ones = np.ones(int(use.sum()), np.int64)
                held.append((contexts[use], words[use].astype(np.uint64), ones))
            size += len(held[-1][1])
            if size > _HELD:
                held = [_summed(held)]
                size = len(held[0][1])
                if size > _HELD // 2:
                    yield _dealt(held[0], trie, buckets)
                    held, size = [], 0
    if size:
        yield _dealt(_summed(held), trie, buckets)


def _shards(
    batches: Iterator[pa.RecordBatch], folder: str, levels: tuple, least: int, last: bool
) -> Iterator[pa.RecordBatch]:
    """Sum up the buckets of a partition and write each as a shard; names differ by attempt.

    Of an entry's context its parent needs the children and their sum alone, so a shard keeps
    these once a context. Counts of the last level are the context of nothing and not kept.
    """
    trie, parts = (_trie(folder, levels) if levels else None), {}
    for batch in batches:
        for bucket, *blobs in zip(*[column.to_pylist() for column in batch.columns]):
            parts.setdefault(bucket, []).append(blobs)
    rows, level = [], len(levels) + 1
    for bucket, blobs in sorted(parts.items()):
        arrays = [
            np.concatenate([_spread(blob, rising, kind) for blob in x])
            for x, rising, kind in zip(
                zip(*blobs), (True, False, False), (np.int64, np.uint64, np.int64)
            )
        ]
        contexts, words, counts = _merged(*arrays)
        once = int((counts == 1).sum())
        if trie is not None and least > 1:
            kept = counts >= least
            contexts, words, counts = contexts[kept], words[kept], counts[kept]
        if not len(words):
            continue
        name = f"{bucket:06d}-{TaskContext.get().taskAttemptId()}"
        shard = Shard(folder, level, {"name": name})
        if trie is None:
            shard.write_sequence("hashes", words, 1 << 64)
            shares = np.log10(counts.astype(float))
        else:
            times = trie.levels[-1].before(contexts)[0]
            shares = np.log10((counts - DISCOUNT) / times)
            width = trie.levels[0].width
            shard.write(words=pack_bits(words, width))
            cuts = np.flatnonzero(np.diff(contexts, prepend=-1))
            own, sums = contexts[cuts] - contexts[0], np.cumsum(np.add.reduceat(counts, cuts))
            for what, rising in (("parents", own), ("begins", cuts), ("sums", sums)):
                shard.write_sequence(what, rising, int(rising[-1]) + 1)
        codes, book = _quantised(shares)
        shard.write(codes=codes, book=book)
        if not last:
            shard.write(counts=counts)
        first = int(contexts[0]), int(words[:1].view(np.int64)[0])
        rows.append((bucket, name, len(words), int(counts.sum()), once, *first))
    columns = [list(x) for x in zip(*rows)] if rows else [[] for _ in range(7)]
    names = [x.split()[0] for x in _SHARDS.split(", ")]
    kinds = [pa.int32(), pa.string(), *[pa.int64()] * 5]
    yield pa.RecordBatch.from_arrays(
        [pa.array(v, t) for v, t in zip(columns, kinds)], names=names
    )


def _pointers(
    batches: Iterator[pa.RecordBatch], folder: str, levels: tuple
) -> Iterator[pa.RecordBatch]:
    """For each shard of the last level but one: where its entries' children begin in the last,
    and the weight that goes to shorter contexts."""
    trie = _trie(folder, levels)
    parent, child = trie.levels[-2:]
    for batch in batches:
        for index in batch.column("index").to_pylist():
            base, end = int(parent.bases[index]), int(parent.bases[index + 1])
            number, seen = np.zeros(end - base, np.int64), np.zeros(end - base)
            first = 0
            for s, row in enumerate(child.rows):
                later = child.rows[s + 1]["first_context"] if s + 1 < len(child.rows) else None
                if row["first_context"] >= end:
                    break
                if later is not None and later < base:
                    first += row["entries"]
                    continue
                start = row["first_context"]
                parents = child.shards[s].sequence("parents").values().astype(np.int64) + start
                lo, hi = np.searchsorted(parents, [base, end])
                begins = child.shards[s].sequence("begins").values().astype(np.int64)
                begins = np.append(begins, row["entries"])
                sums = np.diff(child.shards[s].sequence("sums").values().astype(np.int64), prepend=0)
                first += int(begins[lo])
                own, children = parents[lo:hi] - base, np.diff(begins[lo : hi + 1])
                number[own] += children  # each context is there once
                seen[own] += sums[lo:hi] - DISCOUNT * children
            pointers = np.concatenate([[0], np.cumsum(number)])
            shard = parent.shards[index]
            shard.write_sequence("pointers", pointers, int(pointers[-1]) + 1)
            backs = 1 - seen / np.maximum(shard.array("counts"), 1)
            codes, book = _quantised(np.log10(np.maximum(backs, 1e-9)))
            shard.write(**{
                "pointer_base.meta": np.array([first], np.int64), "backs": codes, "back_book": book,
            })
        yield batch


def tokenised(rows: DataFrame) -> DataFrame:
    """Whole texts of ``rows`` (doc_id, held_out, text) as blocks of tokens in the shared folder.

    Each counting pass and the scoring read the blocks, so texts are split into words once.
    """
    return stored(rows.mapInArrow(_blocks, _BLOCKS), "tokens", _FEW_ROWS)


def train(
    tokens: DataFrame, folder: str, order: int = ORDER, min_count: int = MIN_COUNT
) -> tuple:
    """Build the levels of a trie in ``folder`` from all blocks of ``tokens``, except for the
    documents that are held out. n-grams of two or more words need ``min_count`` occurrences.

    Level by level: tasks count the n-grams of their texts and deal them to buckets that are
    ranges of the trie's order, of equal weight, so one frequent context spreads over many; each
    bucket becomes a shard of files. Only the list of shards comes to the driver. Returns it.
    """
    spark = tokens.sparkSession
    open_folder(folder)[0].create_dir(open_folder(folder)[1], recursive=True)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    levels: tuple = ()
    for n in range(order):
        count = partial(_counted, folder=folder, levels=levels, buckets=buckets, least=min_count)
        training = tokens.select("held_out", "sizes", "hashes", "tokens")
        blobs = training.mapInArrow(count, _BLOBS).repartition("bucket")
        last = n + 1 == order
        shard = partial(_shards, folder=folder, levels=levels, least=min_count, last=last and n > 0)
        shards = blobs.mapInArrow(shard, _SHARDS)
        rows = stored(shards, "shards").orderBy("bucket").collect()  # one row a shard
        if not rows:
            break
        levels += (_frozen(rows),)
        if len(levels) > 1:
            number = len(levels[-2])
            index = spark.range(0, number, 1, number).select(F.col("id").cast("int").alias("index"))
            write = partial(_pointers, folder=folder, levels=levels)
            stored(index.mapInArrow(write, "index int"), "pointers")
    return levels


# Scoring ----------------------------------------------------------------------------------


def _scored(batches: Iterator[pa.RecordBatch], folder: str, levels: tuple):
    """Base score and trie score of each document."""
    trie = _trie(folder, levels) if levels else None
    for batch in batches:
        for row in range(batch.num_rows):
            hashes, flat, place, owner = _block(batch, row)
            real = place > 0
            counts, p = np.zeros(len(flat)), np.full(len(flat), 0.5)
            total, different = 0, 0
            if trie is not None:
                total, different = trie.tokens, trie.words
                known = trie.levels[0].find_words(hashes)
                seen = np.flatnonzero(known >= 0)
                count, weight = np.zeros(len(hashes)), np.full(len(hashes), trie.unknown)
                count[seen] = trie.levels[0].read(known[seen], "counts", int)
                share = trie.levels[0].powers(known[seen], "codes", "book") / total
                weight[seen] = (1 - trie.unknown) * share
                counts, p = count[flat], weight[flat]
                words = known[flat]
                for n, (contexts, _, pairs) in enumerate(
                    trie.grams(words, place, len(trie.levels))
                ):
                    if not n:
                        continue
                    # Each context and n-gram of the block is read once.
                    tokens, back, nth, parents, found = pairs
                    left = trie.levels[n - 1].powers(parents, "backs", "back_book")[nth]
                    hit = np.flatnonzero(found >= 0)
                    more = np.zeros(len(found))
                    more[hit] = trie.levels[n].powers(found[hit], "codes", "book")
                    p[tokens] = p[tokens] * left[back] + more[back]
                    rest = np.flatnonzero((contexts >= 0) & (words < 0))
                    p[rest] *= trie.levels[n - 1].powers(contexts[rest], "backs", "back_book")
            base = np.log10((counts + ADDED) / (total + ADDED * (different + 1)))
            score = np.log10(np.minimum(p, 1.0))
            ids = batch.column("doc_ids")[row].values
            size = len(ids)

            def summed(values: np.ndarray) -> np.ndarray:
                return np.bincount(owner[real], weights=values[real], minlength=size)

            columns = [
                ids,
                batch.column("held_out")[row].values,
                pa.array(summed(np.ones(len(flat))).astype(np.int64)),
                pa.array(summed((counts > 0).astype(float)).astype(np.int64)),
                pa.array(np.full(size, total, np.int64)),
                pa.array(summed(base)),
                pa.array(summed(score)),
            ]
            yield pa.RecordBatch.from_arrays(
                columns, names=[x.split()[0] for x in _SCORES.split(", ")]
            )


def scored(
    docs: DataFrame, folder: str, order: int = ORDER, min_count: int = MIN_COUNT
) -> DataFrame:
    """Score every document with an n-gram model trained on those that aren't held out.

    ``docs`` needs doc_id and text (null: empty); other columns are ignored, repeated rows are
    scored (and counted in training) as often as they come. Held out are documents with
    crc32(doc_id as text) mod 10 = 0 (a null doc_id counts as an empty text, so it is held out).
    A-Z are lower-cased; tokens are the words ``[^\\x20\\x09-\\x0D]+`` of the whole text and one end.

    base_score: sum of log10((c + 0.1) / (N + 0.1 (V + 1))). score: log10 probability by an
    interpolated model. p(w | context) is (count - DISCOUNT) / count of the context, if the
    n-gram was seen at least ``min_count`` times (1 keeps every n-gram), plus the weight left over times p(w | shorter
    context). At the bottom, unknown words together get the share of words seen once
    (Good-Turing) and known ones the rest by their counts. Words are told apart by 64-bit hashes.

    Levels of the trie: word hashes as an Elias-Fano sequence; for each entry an Elias-Fano
    pointer to its children, children's words packed and searched within the context's range,
    probabilities and back-off weights in one byte each. Files are memory-mapped from
    ``folder``, which all executors reach. Without training documents all words are unknown.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.
    """
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.crc32(text.cast("binary")) % 10 == 0).alias("held_out"),
        "text",
    )
    tokens = tokenised(rows)
    levels = train(tokens, folder, order, min_count)
    return tokens.mapInArrow(partial(_scored, folder=folder, levels=levels), _SCORES)

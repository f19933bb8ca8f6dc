"""Quality rules on repetition, measured with suffix arrays over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirespark.llm.common import numbered, split_words, utf8_bytes
from wirespark.llm.token_ids import blocks

SYMBOLS = "#*$%&|<>"
#: Words of the window whose repeats count as repeated words.
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED = 0.20
#: Limits of the suffix-array rule, beyond the base rule.
MIN_SPAN = 3
MAX_COVERED = 0.30
MAX_LONGEST = 50
#: Symbols per word above which a text is junk.
MAX_SYMBOLS = 0.1

#: Words whose suffixes are sorted together; a longer document is sorted alone.
BLOCK_WORDS = 500_000

_MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, n_covered_words bigint, longest_repeat bigint"
)


def longest_repeats(words: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each word of a run of documents: the length in words of the longest string that
    begins there and occurs again in the same document.

    ``words`` are word numbers, ``docs`` the (rising) document numbers. A suffix array of all
    documents is sorted by doubling: suffixes are ranked by their first 1, 2, 4, … words, and
    only those that still tie are sorted further. The common prefix of neighbours in the array
    is read off the ranks of each round, from the longest to the shortest. The larger of the
    two prefixes at a suffix is the height of the deepest LCP interval that holds it.
    """
    n = len(words)
    if n == 0:
        return np.zeros(0, np.int64)
    # A rank is the place of the first suffix of its tie group in the array.
    order = np.lexsort((words, docs))
    first = np.ones(n, bool)
    first[1:] = (words[order][1:] != words[order][:-1]) | (docs[order][1:] != docs[order][:-1])
    # Ranks of 32 bits: all rounds are kept, and a text may have very many words.
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(first, np.arange(n, dtype=np.int32), 0))
    rounds, width = [rank.copy()], 1
    while True:
        size = np.bincount(rank, minlength=n)
        tied = np.flatnonzero(size[rank] > 1)
        if not len(tied):
            break
        # The rank of what follows; past the end or in another document: a rank of its own.
        after = np.minimum(tied + width, n - 1)
        inside = (tied + width < n) & (docs[after] == docs[tied])
        follow = np.where(inside, rank[after], -1 - tied)
        place = np.lexsort((follow, rank[tied]))
        chosen, group, follow = tied[place], rank[tied][place], follow[place]
        fresh = np.ones(len(chosen), bool)
        fresh[1:] = (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])
        begins = np.ones(len(chosen), bool)
        begins[1:] = group[1:] != group[:-1]
        at = np.arange(len(chosen))
        offset = at - np.maximum.accumulate(np.where(begins, at, 0))
        rank = rank.copy()
        rank[chosen] = group + np.maximum.accumulate(np.where(fresh, at, 0)) - (at - offset)
        width *= 2
        rounds.append(rank)
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    left, right = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, np.int64)
    live = np.flatnonzero(rounds[0][left] == rounds[0][right])
    a, b, got = left[live], right[live], np.zeros(len(live), np.int64)
    for level in range(len(rounds) - 1, -1, -1):
        ranks, step = rounds[level], 1 << level
        same = (a < n) & (b < n)
        same[same] = ranks[a[same]] == ranks[b[same]]
        a, b, got = a + same * step, b + same * step, got + same * step
    common[live] = got
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, left, common)
    np.maximum.at(longest, right, common)
    return longest


def covered(longest: np.ndarray, least: int) -> np.ndarray:
    """Which words lie in the union of the repeats of at least ``least`` words."""
    n = len(longest)
    starts = np.flatnonzero(longest >= least)
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + longest[starts], -1)
    return np.cumsum(change[:n]) > 0


def _repetition(bounds: np.ndarray, words: pa.LargeStringArray):
    """Per document: words in repeated windows, words in repeats of MIN_SPAN, longest repeat."""
    docs = len(bounds) - 1
    out = np.zeros((3, docs), np.int64)
    numbers, _ = numbered(words)
    begin = 0
    while begin < docs:
        end = int(np.searchsorted(bounds, bounds[begin] + BLOCK_WORDS, side="right")) - 1
        end = min(max(end, begin + 1), docs)
        lo, hi = bounds[begin], bounds[end]
        if hi > lo:
            lengths = np.diff(bounds[begin : end + 1])
            owner = np.repeat(np.arange(end - begin), lengths)
            longest = longest_repeats(numbers[lo:hi], owner)
            for row, least in ((0, WINDOW), (1, MIN_SPAN)):
                out[row, begin:end] = np.bincount(
                    owner, weights=covered(longest, least), minlength=end - begin
                )
            np.maximum.at(out[2], begin + owner, longest)
        begin = end
    return out


def _repeated_lines(texts: pa.LargeStringArray) -> np.ndarray:
    """Lines with a word that equal an earlier line of the same document."""
    parts = pc.split_pattern(texts, "\n")
    lines, bounds = parts.values, parts.offsets.to_numpy()
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    with_word = np.diff(split_words(lines)[0]) > 0
    numbers, _ = numbered(lines)
    owner, numbers = owner[with_word], numbers[with_word]
    total = np.bincount(owner, minlength=len(texts))
    different = np.unique(owner * (int(numbers.max(initial=0)) + 1) + numbers)
    unlike = np.bincount(different // (int(numbers.max(initial=0)) + 1), minlength=len(texts))
    return total - unlike


_NAMES = [x.split()[0] for x in _MEASURES.split(", ")]


def _measure(texts: pa.LargeStringArray) -> dict[str, np.ndarray]:
    """The measures of some texts."""
    symbol = np.zeros(256, np.uint8)
    symbol[list(SYMBOLS.encode())] = 1
    bounds, words = split_words(texts)
    chars = np.concatenate([[0], np.cumsum(pc.utf8_length(words).to_numpy())])
    data, offsets = utf8_bytes(texts)
    marks = np.concatenate([[0], np.cumsum(symbol[data], dtype=np.int64)])
    repeated, inside, longest = _repetition(bounds, words)
    columns = [
        np.diff(bounds),
        np.diff(chars[bounds]),
        np.diff(marks[offsets]),
        _repeated_lines(texts),
        repeated,
        inside,
        longest,
    ]
    return dict(zip(_NAMES, (x.astype(np.int64) for x in columns), strict=True))


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, end, texts in blocks(batch.column("text")):
            columns = map(pa.array, _measure(texts).values())
            ids = batch.column("doc_id").slice(begin, end - begin)
            yield pa.RecordBatch.from_arrays([ids, *columns], names=["doc_id", *_NAMES])


def _verdicts(measures, max_covered: float, max_longest: int, max_symbols: float):
    """Whether the base rule fails, and whether the document stays; for columns or arrays."""
    m = measures
    failed = (m["n_words"] < MIN_WORDS) | (
        m["n_repeat_words"] * 100 > m["n_words"] * round(100 * MAX_REPEATED)
    )
    fine = (m["n_covered_words"] <= m["n_words"] * max_covered) & (
        m["longest_repeat"] <= max_longest
    )
    fine &= m["n_symbols"] <= m["n_words"] * max_symbols
    return failed, ~failed & fine


def quality(
    docs: DataFrame,
    max_covered: float = MAX_COVERED,
    max_longest: int = MAX_LONGEST,
    max_symbols: float = MAX_SYMBOLS,
) -> DataFrame:
    """Measures of each document, and whether the repetition rules keep it.

    ``docs`` needs doc_id and text; other columns are ignored, repeated rows stay. Words are
    ``[^\\x20\\x09-\\x0D]+`` of the whole text; a null text has none. A suffix array over the
    words gives the longest-common-prefix intervals and with them the maximal repeated
    strings of each document; the union of their spans counts the words inside repeats.

    Base rule: at least ``MIN_WORDS`` words, and at most ``MAX_REPEATED`` of them in repeats
    of ``WINDOW`` words or more. Suffix-array rule: at most ``max_covered`` of the words in
    repeats of ``MIN_SPAN`` words or more, and no repeat longer than ``max_longest`` words.
    Texts with more than ``max_symbols`` symbols a word go too; repetition does not show those.
    An empty table gives an empty result.

    Returns doc_id, n_words, word_chars (code points in words), n_symbols, n_dup_lines (lines
    with a word, equal to an earlier line), n_repeat_words, n_covered_words, longest_repeat,
    base_failed, kept.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    measured = rows.mapInArrow(_measured, f"doc_id bigint, {_MEASURES}")
    columns = {name: F.col(name) for name in _NAMES}
    failed, kept = _verdicts(columns, max_covered, max_longest, max_symbols)
    return measured.withColumn("base_failed", failed).withColumn("kept", kept)


def good_documents(
    docs: DataFrame,
    max_covered: float = MAX_COVERED,
    max_longest: int = MAX_LONGEST,
    max_symbols: float = MAX_SYMBOLS,
) -> DataFrame:
    """The documents that ``quality`` keeps, with all their columns and without a shuffle.

    Each row goes to the worker once, and comes back only if it stays.
    """

    place = docs.columns.index("text")

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin, end, texts in blocks(batch.column(place)):
                _, kept = _verdicts(_measure(texts), max_covered, max_longest, max_symbols)
                yield batch.slice(begin, end - begin).filter(pa.array(kept))

    # Columns go by number, since names with a dot do not reach a worker.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(good, plain.schema).toDF(*docs.columns)

"""Spelling variants: words one edit apart, found by dense comparison of blocks of words."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirespark.llm.common import lower_ascii, stored, text_array
from wirespark.operators.joins import lookup_join

LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH = 6
MIN_COUNT = 5
#: How much more frequent a form must be than its variant.
RATIO = 5
#: One run in so many loses a code point.
SLIP = 199
#: Words of one group that are compared densely; a larger group is split further.
GROUP_WORDS = 2048
#: Cells of a comparison held at once.
TILE_CELLS = 1 << 22
#: Code points of a text that are split into runs at once.
SLICE = 1 << 20
#: Distinct words a task counts before it hands them on.
HELD_WORDS = 200_000

#: What a group has in common: its first or last code points, or (0 and above) all but one place.
PREFIX, SUFFIX = -1, -2

_MATCHES = "word string, n_near bigint, best struct<rank:bigint,form:string>"


def word_counts(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """``(word, n)`` of all words of at least ``min_length`` code points.

    Runs of letters of the whole texts, A-Z in lower case. Where ``SLIP`` divides the CRC-32 h of
    ``<doc_id>:<run>``, the run loses its code point number h modulo its length. A null text has
    no runs, a null doc_id is written as nothing. Tasks count before the shuffle.
    """
    rows = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    run = re.compile(f"[{LETTERS}]{{{min_length},}}")
    border = re.compile(f"[^{LETTERS}]")

    def slices(text: str) -> Iterator[str]:
        at = 0
        while at < len(text):
            cut = border.search(text, at + SLICE)
            end = cut.start() if cut else len(text)
            yield text[at:end]
            at = end

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            texts = lower_ascii(text_array(batch.column("text")))
            for doc_id, text in zip(batch.column("doc_id"), texts, strict=True):
                mark = zlib.crc32(f"{doc_id.as_py()}:".encode())
                for part in slices(text.as_py()):
                    for word, n in Counter(run.findall(part)).items():
                        h = zlib.crc32(word.encode(), mark)
                        if h % SLIP == 0:
                            place = h % len(word)
                            word = word[:place] + word[place + 1 :]
                        held[word] += n
                    if len(held) >= HELD_WORDS:
                        yield _counts(held)
                        held.clear()
        if held:
            yield _counts(held)

    parts = rows.mapInArrow(counted, "word string, n bigint")
    return (
        parts.filter(F.length("word") >= min_length).groupBy("word").agg(F.sum("n").alias("n"))
    )


def _counts(held: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"]
    )


def _groups(words: DataFrame) -> DataFrame:
    """Each word in the groups in which a word one edit away must be met.

    Of two such words the longer has ``longer`` code points. An edit leaves all the others, so
    the words begin alike or end alike in half of them, rounded down. Words of that length and
    one less are grouped by these beginnings and ends.
    """
    length = F.length("word")
    sized = words.select(
        "word", "n", F.explode(F.array(length, length + 1)).alias("longer")
    )
    half = F.floor(F.col("longer") / 2).cast("int")
    ends = F.array(
        F.struct(F.lit(PREFIX).alias("place"), F.substring("word", F.lit(1), half).alias("piece")),
        F.struct(F.lit(SUFFIX).alias("place"), F.substring("word", -half, half).alias("piece")),
    )
    return sized.select("word", "n", "longer", F.inline(ends))


def _without_place(place: Column) -> Column:
    """The word without one place of the longer length; a shorter word has none to lose."""
    lost = (F.length("word") == F.col("longer")).cast("int")
    return F.concat(
        F.substring("word", F.lit(1), place), F.substring("word", place + 1 + lost, F.col("longer"))
    )


def _split(groups: DataFrame, limit: int) -> DataFrame:
    """Groups of more than ``limit`` words dealt anew by all but one place of the word.

    Such a group holds words that differ in one place alone: no more than there are letters. A
    group by beginnings is split at the places after them, one by ends at those before.
    """
    key = ["longer", "place", "piece"]
    sizes = groups.groupBy(*key).agg(F.count(F.lit(1)).alias("size"))
    large = sizes.filter(F.col("size") > limit).withColumn("large", F.lit(True)).drop("size")
    marked = lookup_join(groups, large, key, "left")
    half = F.floor(F.col("longer") / 2).cast("int")
    places = F.when(F.col("place") == PREFIX, F.sequence(half, F.col("longer") - 1)).otherwise(
        F.sequence(F.lit(0), half - 1)
    )
    wanted = F.when(F.col("large"), places).otherwise(F.array(F.col("place")))
    dealt = marked.select("word", "n", "longer", "piece", F.explode(wanted).alias("place"))
    piece = F.when(F.col("place") < 0, F.col("piece")).otherwise(_without_place(F.col("place")))
    return dealt.select("word", "n", "longer", "place", piece.alias("piece"))


def code_points(words: list[str], width: int, right: bool = False) -> np.ndarray:
    """Words as rows of code points, padded with zeros at the end or, for ``right``, the front."""
    padded = "".join(w.rjust(width, "\0") if right else w.ljust(width, "\0") for w in words)
    return np.frombuffer(padded.encode("utf-32-le"), np.uint32).reshape(len(words), width)


def single_edits(
    a: list[str], b: list[str], longer: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which words of ``a`` and ``b`` (words x words) are one edit apart, the longer of the two
    of ``longer`` code points; with their common prefixes and suffixes.

    Column by column of the padded matrices all pairs are compared; prefix and suffix together
    reach the longer length less one exactly where one insertion, deletion or replacement leads
    from one word to the other.
    """
    lengths_a = np.array([len(w) for w in a])[:, None]
    lengths_b = np.array([len(w) for w in b])[None, :]
    shorter = np.minimum(lengths_a, lengths_b)

    def common(right: bool) -> np.ndarray:
        x, y = code_points(a, longer, right), code_points(b, longer, right)
        alike = np.ones((len(a), len(b)), bool)
        size = np.zeros((len(a), len(b)), np.int32)
        for i in range(longer - 1, -1, -1) if right else range(longer):
            alike &= x[:, i, None] == y[None, :, i]
            if not alike.any():
                break
            size += alike
        return np.minimum(size, shorter)

    prefix, suffix = common(False), common(True)
    near = (prefix + suffix >= longer - 1) & (np.maximum(lengths_a, lengths_b) == longer)
    near &= (prefix < longer) & (shorter >= longer - 1)
    return near, prefix, suffix


def _tile(words: list[str], longer: int, place: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (indices) of a group's words one edit apart, of which this group has to tell.

    A pair may meet in several groups. It is told by the group of its beginnings if these are
    alike, by that of its ends otherwise; of groups split by places by the first possible place.
    """
    half = longer // 2
    side = max(1, min(len(words), math.isqrt(TILE_CELLS // max(1, longer // 8))))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for top in range(0, len(words), side):
        for left in range(top, len(words), side):
            near, prefix, suffix = single_edits(
                words[top : top + side], words[left : left + side], longer
            )
            if place == SUFFIX:
                near &= prefix < half
            elif place >= half:
                near &= np.maximum(half, longer - 1 - suffix) == place
            elif place >= 0:
                near &= (prefix < half) & (np.maximum(0, longer - 1 - suffix) == place)
            rows, columns = np.nonzero(near)
            rows, columns = rows + top, columns + left
            once = rows < columns
            found.append((rows[once], columns[once]))
    return tuple(np.concatenate(part) for part in zip(*found, strict=True))


def _matches(groups: DataFrame) -> DataFrame:
    """Per group and word: how many words of the group are near, and the best of them."""
    key = ["longer", "place", "piece"]
    dealt = groups.repartition(*key).sortWithinPartitions(*key, "word")

    def matched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, words, counts = None, [], []
        for batch in batches:
            out: list[dict] = []
            columns = [batch.column(c).to_pylist() for c in (*key, "word", "n")]
            for longer, place, piece, word, n in zip(*columns, strict=True):
                if current != (longer, place, piece):
                    out += _best(words, counts, current)
                    current, words, counts = (longer, place, piece), [], []
                words.append(word)
                counts.append(n)
            if out:
                yield pa.RecordBatch.from_pylist(out, _MATCH_SCHEMA)
        if out := _best(words, counts, current):
            yield pa.RecordBatch.from_pylist(out, _MATCH_SCHEMA)

    return dealt.select(*key, "word", "n").mapInArrow(matched, _MATCHES)


_MATCH_SCHEMA = pa.schema(
    {
        "word": pa.string(),
        "n_near": pa.int64(),
        "best": pa.struct({"rank": pa.int64(), "form": pa.string()}),
    }
)


def _best(words: list[str], counts: list[int], group: tuple | None) -> list[dict]:
    if len(words) < 2:
        return []
    a, b = _tile(words, group[0], group[1])
    if not len(a):
        return []
    one, other = np.concatenate([a, b]), np.concatenate([b, a])
    n = np.array(counts)
    # Words of a group are sorted, so the smaller index is the smaller word.
    order = np.lexsort((other, -n[other], one))
    first = np.flatnonzero(np.diff(one[order], prepend=-1))
    n_near = np.diff(np.append(first, len(order)))
    return [
        {
            "word": words[w],
            "n_near": k,
            "best": {"rank": -counts[form], "form": words[form]},
        }
        for w, form, k in zip(
            one[order][first].tolist(), other[order][first].tolist(), n_near.tolist(), strict=True
        )
    ]


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """``(word, root)`` of words with a form: the last word that forms lead to.

    Every step multiplies the count by ``RATIO`` at least, so the longest chain is bounded by the
    largest count; each round doubles the steps taken.
    """
    steps = 1
    while RATIO**steps * MIN_COUNT <= most:
        steps += 1
    leads = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        leads = stored(leads, "roots")
        further = leads.select(F.col("word").alias("root"), F.col("root").alias("next"))
        leads = lookup_join(leads, further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root")
        )
    return leads


def variants(
    docs: DataFrame,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    group_words: int = GROUP_WORDS,
) -> DataFrame:
    """Words of the texts with the frequent word that each is a spelling of.

    ``docs`` needs doc_id and text; other columns are ignored and repeated rows count. Words have
    at least ``min_length`` code points and ``min_count`` occurrences (see ``word_counts``). Two
    are near if one inserted, deleted or replaced code point leads from one to the other. A
    word's form is its most frequent near word (of equal ones the smallest), if it is ``RATIO``
    times as frequent; the root is where forms lead to. An empty table gives no rows.

    Returns word, form, root, n, n_near, form_n.
    """
    words = stored(
        word_counts(docs, min_length).filter(F.col("n") >= min_count), "words"
    )
    found = _matches(_split(_groups(words), group_words))
    near = found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min("best").alias("best")
    )
    best_n = -F.col("best.rank")
    chosen = F.coalesce(best_n >= F.col("n") * RATIO, F.lit(False))
    described = lookup_join(words, near, "word", "left").select(
        "word",
        F.when(chosen, F.col("best.form")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(chosen, best_n).alias("form_n"),
    )
    described = stored(described, "forms")
    most = words.agg(F.max("n")).first()[0] or 0
    roots = _roots(described.filter(F.col("form").isNotNull()), most)
    return lookup_join(described, roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )

"""Near-duplicate join on word n-grams with count vectors in pages of an R-tree."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wirespark.llm.common import (
    carried,
    lower_ascii,
    mixed,
    numbered,
    restored,
    spans,
    split_words,
    stored,
    word_hashes,
)
from wirespark.llm.components import connected
from wirespark.llm.token_ids import blocks
from wirespark.operators.joins import lookup_join

#: Words of a shingle, and the similarity as a fraction.
WORDS = 4
SIMILAR = (85, 100)
#: Coordinates of a count vector.
GROUPS = 256
#: Points of a page, and of a group of points that one task compares.
PAGE, BLOCK = 32, 256
#: Pairs of points compared at once.
PAIRS = 8_000
#: Keys that a task holds before it deals them out.
HELD_KEYS = 500_000

_STEP = np.uint64(0x9E3779B97F4A7C15)
_SETS = "doc_id bigint, row bigint, n_shingles bigint, set_id bigint, left_0 int, left_1 int"
_ENTRIES = "bucket int, keys binary, sets binary, lowers binary"
_CELLS = "cell bigint, set_id bigint, lower int, members bigint"
_POINTS = "set_id bigint, n_shingles bigint, shingles array<bigint>, point binary"


# Shingle sets -----------------------------------------------------------------------------


def _word_hashes(texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    bounds, words = split_words(lower_ascii(texts))
    numbers, different = numbered(words)
    return bounds, word_hashes(different)[numbers]


def shingle_sets(texts: pa.LargeStringArray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the distinct shingles of each text (sorted), and where each begins.

    A text with fewer words than a shingle has its whole sequence as the only one.
    """
    bounds, words = _word_hashes(texts)
    rows = []
    grams = words.copy()
    whole = len(words) - width + 1
    for i in range(1, width):
        if whole > 0:
            grams[:whole] = mixed(grams[:whole] * _STEP + words[i : i + whole])
    for begin, end in zip(bounds[:-1], bounds[1:]):
        if end - begin >= width:
            rows.append(np.unique(grams[begin : end - width + 1]))
        elif end > begin:
            short = np.uint64(end - begin)
            for word in words[begin:end]:
                short = mixed(np.array([short], np.uint64) * _STEP + word)[0]
            rows.append(np.array([short], np.uint64))
        else:
            rows.append(np.zeros(0, np.uint64))
    flat = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
    return flat, np.cumsum([0, *map(len, rows)])


@lru_cache(maxsize=8)
def _bands(num: int, den: int, largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First set size of each size band; groups and spare groups of each.

    Similar sets lie in the same band or in neighbours. The pairs of a band (its own sets and
    those of the next) differ by at most d shingles, so of d + 1 + spare groups into which
    the shingles are hashed, at least spare + 1 hold the same. No groups: sets so small that
    only equal ones are similar.
    """
    first = [1]
    while first[-1] <= largest:
        first.append(max(first[-1] + 1, -(-first[-1] * den // num)))
    first.append(max(first[-1] + 1, -(-first[-1] * den // num)))
    first.append(max(first[-1] + 1, -(-first[-1] * den // num)))
    first = np.array(first, np.int64)
    small = first[1:-1] - 1
    both = small + np.minimum(first[2:] - 1, small * den // num)
    differ = both * (den - num) // (den + num)
    spare = -(-(differ + 1) // 10)
    groups = np.where(differ > 0, differ + 1 + spare, 0)
    return first, groups, np.where(groups > 0, spare, 0)


def _grouped(flat: np.ndarray, bounds: np.ndarray, lower: int, ratio: tuple[int, int]):
    """Group contents of each set in its own band (lower 0) or the one below (1).

    Returns the sum and count of the shingles of each group, the set and the group it
    belongs to, the band of each set, and the spare groups.
    """
    sizes = np.diff(bounds)
    first, groups, spare = _bands(*ratio, int(sizes.max(initial=1)))
    band = np.searchsorted(first, sizes, side="right") - 1 - lower
    valid = (sizes > 0) & (band >= 0)
    many = np.where(valid, groups[np.maximum(band, 0)], 0)
    base = np.cumsum(many) - many
    owner = np.repeat(np.arange(len(sizes)), sizes)
    used = many[owner] > 0
    owner, values = owner[used], flat[used]
    place = ((values >> np.uint64(32)) * many[owner].astype(np.uint64)) >> np.uint64(32)
    slot = base[owner] + place.astype(np.int64)
    total = int(many.sum())
    sums = np.zeros(total, np.uint64)
    np.add.at(sums, slot, mixed(values))
    counts = np.bincount(slot, minlength=total)
    owners = np.repeat(np.arange(len(sizes)), many)
    left = np.where(many > 0, spare[np.maximum(band, 0)], 0)
    return sums, counts, owners, spans(many), band, left


def _set_ids(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit number for each set, equal for equal sets."""
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(flat ^ _STEP))])
    sizes = np.diff(bounds).astype(np.uint64)
    return mixed((sums[bounds[1:]] - sums[bounds[:-1]]) + sizes * _STEP).view(np.int64)


def _describe(batches: Iterator[pa.RecordBatch], width: int, ratio: tuple[int, int]):
    """Size and number of each document's set, and the spare groups left after empty ones."""
    for batch in batches:
        for begin, end, texts in blocks(batch.column("text")):
            flat, bounds = shingle_sets(texts, width)
            sizes, left = np.diff(bounds), []
            for lower in (0, 1):
                _, counts, owners, _, _, spare = _grouped(flat, bounds, lower, ratio)
                empty = np.bincount(owners[counts == 0], minlength=len(sizes))
                left.append(np.maximum(spare - empty, 0))
            columns = [
                batch.column("doc_id").slice(begin, end - begin),
                batch.column("row").slice(begin, end - begin),
                pa.array(sizes),
                pa.array(_set_ids(flat, bounds), mask=sizes == 0),
                *[pa.array(x.astype(np.int32)) for x in left],
            ]
            yield pa.RecordBatch.from_arrays(
                columns, names=["doc_id", "row", "n_shingles", "set_id", "left_0", "left_1"]
            )


def _entries(batches, width: int, ratio: tuple[int, int], buckets: int):
    """What the sets of a task look up: for each group with its content a key, dealt to buckets.

    Empty groups are the most frequent of all; they are left out as far as spare groups go.
    """
    keys, sets, lowers, held = [], [], [], 0
    for batch in batches:
        for _, _, texts in blocks(batch.column("text")):
            flat, bounds = shingle_sets(texts, width)
            names = _set_ids(flat, bounds)
            for lower in (0, 1):
                sums, counts, owners, group, band, spare = _grouped(flat, bounds, lower, ratio)
                empty = counts == 0
                nth = np.cumsum(empty)
                before = np.concatenate([[0], nth])[
                    np.searchsorted(owners, owners, side="left")
                ] if len(owners) else nth
                kept = ~empty | (nth - before > spare[owners])
                where = (band[owners] << 32) + (group << 1)
                key = mixed(sums + mixed(where.astype(np.uint64)) + counts.astype(np.uint64))
                keys.append(key[kept])
                sets.append(names[owners[kept]])
                lowers.append(np.full(int(kept.sum()), lower, np.uint8))
                held += int(kept.sum())
            if held > HELD_KEYS:
                yield _dealt(keys, sets, lowers, buckets)
                keys, sets, lowers, held = [], [], [], 0
    if held:
        yield _dealt(keys, sets, lowers, buckets)


def _dealt(keys: list, sets: list, lowers: list, buckets: int) -> pa.RecordBatch:
    key, name, lower = np.concatenate(keys), np.concatenate(sets), np.concatenate(lowers)
    bucket = ((key >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
    order = np.lexsort((name, key))  # by bucket too: buckets are ranges of keys
    key, name, lower, bucket = key[order], name[order], lower[order], bucket[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
    key, name, lower, bucket = key[fresh], name[fresh], lower[fresh], bucket[fresh]
    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
    ends = np.append(cuts[1:], len(key))
    columns = [pa.array(bucket[cuts])]
    for values in (key, name, lower):
        columns.append(
            pa.array([values[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary())
        )
    return pa.RecordBatch.from_arrays(columns, names=["bucket", "keys", "sets", "lowers"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of a partition that two or more different sets have."""
    parts = {"keys": [], "sets": [], "lowers": []}
    for batch in batches:
        for name, kind in (("keys", np.uint64), ("sets", np.int64), ("lowers", np.uint8)):
            blobs = batch.column(name).to_pylist()
            parts[name].append(np.frombuffer(b"".join(blobs), dtype=kind))
    if not parts["keys"]:
        return
    key, name, lower = (np.concatenate(x) for x in parts.values())
    order = np.lexsort((name, key))
    key, name, lower = key[order], name[order], lower[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
    key, name, lower = key[fresh], name[fresh], lower[fresh]
    cuts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(cuts, len(key)))
    members = np.repeat(size, size)
    many = members > 1
    for at in range(0, max(1, int(many.sum())), 100_000):
        rows = np.flatnonzero(many)[at : at + 100_000]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(key[rows].view(np.int64)),
                pa.array(name[rows]),
                pa.array(lower[rows].astype(np.int32)),
                pa.array(members[rows].astype(np.int64)),
            ],
            names=["cell", "set_id", "lower", "members"],
        )


def _points(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Each set with its shingles and its count vector."""
    for batch in batches:
        for _, _, texts in blocks(batch.column("text")):
            flat, bounds = shingle_sets(texts, width)
            owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
            group = (flat % np.uint64(GROUPS)).astype(np.int64)
            counts = np.bincount(owner * GROUPS + group, minlength=len(texts) * GROUPS)
            points = counts.astype("<u4").reshape(-1, GROUPS)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(_set_ids(flat, bounds)),
                    pa.array(np.diff(bounds)),
                    pa.ListArray.from_arrays(
                        pa.array(bounds.astype(np.int32)), pa.array(flat.view(np.int64))
                    ),
                    pa.array([p.tobytes() for p in points], pa.binary()),
                ],
                names=["set_id", "n_shingles", "shingles", "point"],
            )


# The tree ---------------------------------------------------------------------------------


def _packed_order(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sort-tile-recursive order: slabs by size, tiles by the coordinate that varies most."""
    slab = max(PAGE, int(np.sqrt(len(sizes) * PAGE)))
    by_size = np.argsort(sizes, kind="stable")
    widest = int(np.argmax(points.var(axis=0))) if len(points) else 0
    rank = np.empty(len(sizes), np.int64)
    rank[by_size] = np.arange(len(sizes)) // slab
    return np.lexsort((points[:, widest], rank))


def tree_pairs(
    a: np.ndarray, a_sizes: np.ndarray, b: np.ndarray, b_sizes: np.ndarray, ratio: tuple[int, int]
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of a, row of b) whose count vectors allow the similarity.

    Two sets share at most the sum of the smaller counts over the groups. The points of b are
    packed into pages under boxes, whose largest counts bound all points inside; a query goes on
    only into boxes, pages and points whose bound reaches what the similarity asks for.
    """
    num, den = ratio
    order = _packed_order(b, b_sizes)
    b, b_sizes = b[order].astype(np.int64), b_sizes[order]
    levels = [(b, b_sizes)]
    for fan in (PAGE, PAGE):
        points, sizes = levels[-1]
        cuts = np.arange(0, len(points), fan)
        levels.append((np.maximum.reduceat(points, cuts), np.minimum.reduceat(sizes, cuts)))
    left, right = [], []
    for query in range(len(a)):
        point, size = a[query].astype(np.int64), int(a_sizes[query])
        inside = np.arange(len(levels[-1][0]))
        for depth in range(len(levels) - 1, -1, -1):
            points, sizes = levels[depth]
            shared = np.minimum(points[inside], point).sum(axis=1)
            enough = shared * (num + den) >= num * (size + sizes[inside])
            inside = inside[enough]
            if depth and len(inside):
                inside = (inside[:, None] * PAGE + np.arange(PAGE)).ravel()
                inside = inside[inside < len(levels[depth - 1][0])]
        left.append(np.full(len(inside), query))
        right.append(order[inside])
    return np.concatenate(left), np.concatenate(right)


def _page_pairs(frame: pd.DataFrame, starts: np.ndarray, ratio: tuple[int, int]):
    """Pairs within groups of at most one page each: every point against the later ones."""
    num, den = ratio
    sizes = np.diff(np.append(starts, len(frame)))
    place, length = spans(sizes), np.repeat(sizes, sizes)
    later = length - 1 - place
    one = np.repeat(np.arange(len(frame)), later)
    two = one + 1 + spans(later)
    roots, counts = frame["root"].to_numpy(), frame["n_shingles"].to_numpy()
    apart = roots[one] != roots[two]
    one, two = one[apart], two[apart]
    points = np.frombuffer(b"".join(frame["point"]), dtype="<u4").reshape(-1, GROUPS)
    shared = np.concatenate(
        [np.zeros(0, np.int64)]
        + [
            np.minimum(points[one[i : i + PAIRS]], points[two[i : i + PAIRS]]).sum(axis=1)
            for i in range(0, len(one), PAIRS)
        ]
    )
    enough = shared * (num + den) >= num * (counts[one] + counts[two])
    one, two = one[enough], two[enough]
    first = _first_shared(frame, one, frame, two)
    names = frame["set_id"].to_numpy()
    return names[one[first]], names[two[first]]


def _first_shared(a: pd.DataFrame, rows_a: np.ndarray, b: pd.DataFrame, rows_b: np.ndarray):
    """Whether a pair's cell is the least that both are in, so each pair comes out once."""
    if not len(rows_a):
        return np.zeros(0, bool)
    cells = a["cell"].to_numpy()[rows_a]
    left, right = a["cells"].to_numpy()[rows_a], b["cells"].to_numpy()[rows_b]
    earlier = [x[x < cell] for x, cell in zip(left, cells)]
    met = [len(x) and bool(np.isin(x, y).any()) for x, y in zip(earlier, right)]
    return ~np.array(met, bool)


def _block_pairs(rows: pd.DataFrame, ratio: tuple[int, int]):
    """Pairs of a block with itself or with another one, by the tree."""
    i, j = rows["i"].iloc[0], rows["j"].iloc[0]
    first, second = rows[rows["block"] == i], rows[rows["block"] == j]
    if first.empty or second.empty:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    points, sizes, roots, names = zip(*[
        (
            np.frombuffer(b"".join(x["point"]), dtype="<u4").reshape(-1, GROUPS),
            x["n_shingles"].to_numpy(),
            x["root"].to_numpy(),
            x["set_id"].to_numpy(),
        )
        for x in (first, second)
    ])
    one, two = tree_pairs(points[0], sizes[0], points[1], sizes[1], ratio)
    apart = roots[0][one] != roots[1][two]
    one, two = one[apart], two[apart]
    new = _first_shared(first, one, second, two)
    return names[0][one[new]], names[1][two[new]]


def _search(batches: Iterator[pa.RecordBatch], ratio: tuple[int, int]) -> Iterator[pa.RecordBatch]:
    """Pairs of different components that the points allow, group by group of sorted rows."""
    rest = None
    for batch in _with_last(batches):
        if batch is not None:
            frame = batch.to_pandas()
            rest = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
        if rest is None or rest.empty:
            continue
        keys = rest[["cell", "i", "j"]].to_numpy()
        starts = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
        ready = len(rest) if batch is None else starts[-1]
        if not ready:
            continue
        now, rest = rest.iloc[:ready], rest.iloc[ready:].reset_index(drop=True)
        starts = starts[starts < ready]
        sizes = np.diff(np.append(starts, ready))
        small = np.repeat((sizes <= PAGE) & (now["i"] == now["j"]).to_numpy()[starts], sizes)
        found = []
        if small.any():
            page = now[small].reset_index(drop=True)
            cells = page["cell"].to_numpy()
            found.append(
                _page_pairs(page, np.flatnonzero(np.append(True, cells[1:] != cells[:-1])), ratio)
            )
        for begin, size in zip(starts, sizes):
            if not small[begin]:
                found.append(_block_pairs(now.iloc[begin : begin + size], ratio))
        a = np.concatenate([x for x, _ in found])
        b = np.concatenate([x for _, x in found])
        pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1), axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _with_last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


# The join ---------------------------------------------------------------------------------


def _verified(pairs: DataFrame, points: DataFrame, ratio: tuple[int, int]) -> DataFrame:
    """The pairs a, b whose shingle sets are similar."""
    num, den = ratio
    one = points.select(F.col("set_id").alias("a"), F.col("shingles").alias("_a"))
    two = points.select(F.col("set_id").alias("b"), F.col("shingles").alias("_b"))
    both = F.size(F.array_intersect("_a", "_b"))
    joined = pairs.join(one, "a").join(two, "b").withColumn("_both", both)
    union = F.size("_a") + F.size("_b") - F.col("_both")
    return joined.filter(F.col("_both") * den >= union * num).select("a", "b")


def _with_roots(cells: DataFrame, roots: DataFrame) -> DataFrame:
    named = roots.select(F.col("node").alias("set_id"), "root")
    return cells.join(named, "set_id", "left").withColumn(
        "root", F.coalesce("root", "set_id")
    )


def _stars(cells: DataFrame, pick) -> DataFrame:
    """In each cell with several components, pairs of one set with those of other components."""
    chosen = cells.groupBy("cell").agg(
        pick(F.struct("set_id", "root")).alias("centre"),
        F.min("root").alias("low"),
        F.max("root").alias("high"),
    )
    centres = chosen.filter("low < high").select("cell", "centre.*")
    centres = centres.withColumnsRenamed({"set_id": "centre", "root": "centre_root"})
    met = cells.join(centres, "cell").filter("root != centre_root")
    return met.select(
        F.least("set_id", "centre").alias("a"), F.greatest("set_id", "centre").alias("b")
    ).distinct()


def near_duplicates(
    docs: DataFrame, width: int = WORDS, ratio: tuple[int, int] = SIMILAR
) -> DataFrame:
    """Classes of documents linked by similar sets of word shingles.

    ``docs`` needs doc_id and text; other columns are ignored. A-Z are lower-cased; words are
    ``[^\\x20\\x09-\\x0D]+`` of the whole text. Documents link when the Jaccard similarity of
    their sets of ``width``-word shingles is at least ``ratio``; a text with fewer words has its
    whole sequence as the only shingle, one without words or a null text links with nothing.
    Shingles and sets are compared by 64-bit hashes.

    Equal sets are one point, whatever their number. A point is the vector of counts of
    its shingles over hashed groups. Points are first dealt to cells that every similar pair
    shares: by size band and by a group that agrees in count and content (``_bands`` says why
    one must). Each set leaves out its most frequent cells as far as it has spare groups, so
    common passages gather no documents. In a cell, one set is compared with all others; cells that
    this does not make one component are searched with an R-tree over the points
    (``tree_pairs``), large ones block by block. Every surviving pair is verified on the sets.
    So a large group of copies costs its number of members, not of pairs.

    Returns doc_id, n_shingles, component_id (the smallest doc_id reachable by links; null if
    no document of the component has one).
    """
    return near_duplicate_rows(docs, width, ratio).select("doc_id", "n_shingles", "component_id")


def _row() -> Column:
    """What tells the rows of documents apart: a hash of doc_id and text."""
    return F.xxhash64(F.col("doc_id").cast("bigint"), "text")


def near_duplicate_rows(
    docs: DataFrame, width: int = WORDS, ratio: tuple[int, int] = SIMILAR
) -> DataFrame:
    """``near_duplicates`` with each document's row (``_row``) and root, the set that names its
    component (null: none)."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    named = rows.withColumn("row", _row())
    sets = stored(named.mapInArrow(partial(_describe, width=width, ratio=ratio), _SETS), "sets")
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    entries = rows.mapInArrow(
        partial(_entries, width=width, ratio=ratio, buckets=buckets), _ENTRIES
    )
    shared = stored(entries.repartition("bucket").mapInArrow(_shared, _CELLS), "cells")

    known = sets.filter("set_id IS NOT NULL")
    kinds = known.groupBy("set_id").agg(
        F.min("doc_id").alias("doc_id"),
        F.first("left_0").alias("left_0"),
        F.first("left_1").alias("left_1"),
    )
    frequent = Window.partitionBy("set_id", "lower").orderBy(F.desc("members"), "cell")
    left = F.when(F.col("lower") == 0, F.col("left_0")).otherwise(F.col("left_1"))
    informed = shared.join(kinds, "set_id").withColumn("nth", F.row_number().over(frequent))
    cells = stored(
        informed.filter(F.col("nth") > left).select("cell", "set_id", "doc_id"), "cells"
    )

    wanted = cells.select("doc_id", F.col("set_id").alias("_set")).distinct()
    texts = rows.join(wanted.hint("shuffle_hash"), "doc_id").select("text")
    describe = partial(_points, width=width)
    points = texts.mapInArrow(describe, _POINTS)
    # A set that no document with a doc_id has is fetched by its number.
    unnamed = rows.filter("doc_id IS NULL").select("text").mapInArrow(describe, _POINTS)
    orphans = wanted.filter("doc_id IS NULL").select(F.col("_set").alias("set_id"))
    points = points.union(unnamed.join(orphans, "set_id", "left_semi"))
    points = stored(points.dropDuplicates(["set_id"]), "points")

    cells = cells.select("cell", "set_id").distinct()
    current = cells.withColumn("root", F.col("set_id"))
    tree = partial(_tree_search, points=points, ratio=ratio)
    tested = spark.createDataFrame([], "a bigint, b bigint")
    roots = spark.createDataFrame([], "node bigint, root bigint")
    for search in (partial(_stars, pick=F.min), partial(_stars, pick=F.max), tree):
        pairs = search(current).join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        found = _verified(pairs, points, ratio)
        merged = found.union(roots.select(F.col("node").alias("a"), F.col("root").alias("b")))
        tested = tested.union(pairs)
        roots = connected(merged, "a", "b")
        current = stored(_with_roots(cells, roots), "current")

    named = _with_roots(known.select("doc_id", "row", "n_shingles", "set_id"), roots)
    named = named.select("doc_id", "row", "n_shingles", "root")
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    alone = sets.filter("set_id IS NULL").withColumns(
        {"component_id": F.col("doc_id"), "root": F.lit(None).cast("bigint")}
    )
    columns = ["doc_id", "row", "n_shingles", "component_id", "root"]
    return lookup_join(named, least, "root").select(columns).union(alone.select(columns))


def one_of_each(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """One document of each class: the one with the smallest doc_id, rows without one last;
    of equal rows, one.

    ``classes`` is the result of ``near_duplicate_rows``. Rows are told apart by doc_id and
    text, so different texts of one doc_id, or without one, each stay if their classes differ.
    """
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    linked = classes.filter("root IS NOT NULL").groupBy("root").agg(F.min(order).alias("first"))
    alone = classes.filter("root IS NULL").select("row").distinct()
    first = linked.select("first.row").union(alone)
    joined = docs.select(_row().alias("row"), carried(docs)).join(first, "row", "left_semi")
    nth = F.row_number().over(Window.partitionBy("row").orderBy("row"))
    once = joined.withColumn("nth", nth).filter("nth = 1")
    return once.select(restored(docs.columns))


def _tree_search(cells: DataFrame, points: DataFrame, ratio: tuple[int, int]) -> DataFrame:
    """Candidate pairs between components, from the cells that still hold several."""
    open_cells = cells.groupBy("cell").agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("members")
    )
    # The two stars have tested all pairs of up to three sets.
    open_cells = open_cells.filter("low < high AND members > 3").select("cell", "members")
    shapes = points.select("set_id", "n_shingles", "point")
    inside = cells.join(open_cells, "cell")
    mine = inside.groupBy("set_id").agg(F.array_sort(F.collect_set("cell")).alias("cells"))
    members = inside.join(shapes.join(mine, "set_id"), "set_id")
    many = F.ceil(F.col("members") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("set_id"), many).cast("int")
    blocked = members.withColumn("block", block)
    # Each block meets every other one once: a task never holds more than two blocks.
    other = F.explode(F.sequence(F.lit(0), many - 1))
    dealt = blocked.withColumn("other", other).select(
        "cell",
        F.least("block", "other").alias("i"),
        F.greatest("block", "other").alias("j"),
        "block",
        "set_id",
        "root",
        "n_shingles",
        "point",
        "cells",
    )
    groups = dealt.repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    return groups.mapInArrow(partial(_search, ratio=ratio), "a bigint, b bigint").distinct()

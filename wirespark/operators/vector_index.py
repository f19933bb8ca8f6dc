"""Nearest vectors of many queries by an inverted file: vectors in cells around centroids.

The centroids are fitted on a bounded sample; every vector is in the cell of its nearest one.
A query looks into the cells whose centroids are nearest to it. A cell also keeps how far its
vectors lie from the centroid, which bounds the similarity of anything in it: the exact mode goes
on to all cells that this bound does not rule out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wirespark.operators.keyed import top_n_per_key
from wirespark.session import written

DIGITS = 6
#: Vectors that centroids are fitted on, those with the smallest hashes of their keys.
SAMPLE_ROWS = 20_000
#: Vectors of the sample for each centroid, at least.
SAMPLE_PER_CELL = 16
FIT_ROUNDS = 8
#: Vectors of a cell that are compared together; a larger cell has several parts.
PART_ROWS = 16_384
#: Similarities computed at once.
SCORES = 1 << 20
#: Rows that a task makes of queries at once.
SENT_ROWS = 4096
#: Queries, of the sample, that the number of probes is chosen by, and neighbours of each.
TRIAL_QUERIES, TRIAL_NEIGHBOURS = 200, 20
#: Share of their nearest neighbours that the probed cells must hold.
RECALL = 0.95
#: Similarities are rounded; bounds of angles are given this much room.
SLACK = 2 * 10.0**-DIGITS


def unit_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """``(key, unit)``: vectors of length one. Null, zero and non-finite ones have no direction
    and are left out."""
    given = df.select(key, F.col(vector).cast("array<double>").alias("given"))
    finite = given.filter(
        F.forall("given", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    )
    squares = F.aggregate("given", F.lit(0.0), lambda total, x: total + x * x)
    measured = finite.withColumn("length", F.sqrt(squares)).filter("length > 0")
    return measured.select(key, F.transform("given", lambda x: x / F.col("length")).alias("unit"))


def _fitted(sample: np.ndarray, cells: int) -> np.ndarray:
    """Centroids of length one on the sample; the first vectors of it to begin with."""
    centroids = sample[:cells].copy()
    for _ in range(FIT_ROUNDS):
        nearest = (sample @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centroids = np.where(length > 0, sums / np.where(length > 0, length, 1), centroids)
    return centroids


def write_index(
    df: DataFrame,
    key: str,
    vector: str,
    path: str,
    cells: int | None = None,
    recall: float = RECALL,
) -> None:
    """Write the index of ``df`` below ``path``: vectors by cell, the cells, and how many to probe.

    All vectors must have the same length. ``cells`` is the square root of their number unless
    given, and no more than the sample supports. A cell with more than ``PART_ROWS`` vectors is
    cut into parts by a hash of the key, so no cell, however crowded, is one task's. The
    neighbours of some queries are found exactly; the number of probes is the least that finds
    ``recall`` of them.
    """
    units = written(unit_vectors(df, key, vector), "units")
    hashed = units.orderBy(F.xxhash64(key), key).limit(SAMPLE_ROWS)
    sample = np.array([r["unit"] for r in hashed.select("unit").collect()])
    if cells is None:
        cells = round(units.count() ** 0.5)
    cells = max(1, min(cells, len(sample) // SAMPLE_PER_CELL))
    centroids = _fitted(sample, cells) if len(sample) else np.zeros((0, 0))

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few_scores(batches, len(centroids)):
            cosine = matrix(batch.column("unit")) @ centroids.T
            cell = cosine.argmax(axis=1)
            near = np.take_along_axis(cosine, cell[:, None], axis=1)[:, 0]
            columns = [batch.column(key), batch.column("unit"), pa.array(cell, pa.int32()), pa.array(near)]
            yield pa.RecordBatch.from_arrays(columns, [key, "unit", "cell", "near"])

    schema = T.StructType([*units.schema.fields, *T.StructType.fromDDL("cell int, near double").fields])
    placed = written(units.mapInArrow(assigned, schema), "placed")
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("size"), F.min("near").alias("near"))
    rows = [
        (r["cell"], centroids[r["cell"]].tolist(), -(-r["size"] // PART_ROWS), r["near"])
        for r in sizes.collect()
    ]
    kept = df.sparkSession.createDataFrame(
        rows, "cell int, centroid array<double>, parts int, near double"
    )
    kept.coalesce(1).write.parquet(f"{path}/cells")
    part = F.pmod(F.xxhash64(key), F.col("parts")).cast("int")
    cut = placed.join(F.broadcast(kept.select("cell", "parts")), "cell")
    cut = cut.select(key, "unit", part.alias("part"), "cell").hint("rebalance", "cell")
    cut.write.partitionBy("cell").parquet(f"{path}/vectors")
    probes = _probes_for(placed, hashed.limit(TRIAL_QUERIES), key, path, recall) if rows else 1
    chosen = df.sparkSession.createDataFrame([(probes,)], "probes int")
    chosen.coalesce(1).write.parquet(f"{path}/probes")


def _probes_for(
    placed: DataFrame, queries: DataFrame, key: str, path: str, recall: float
) -> int:
    """The number of probes that finds a share of the exact neighbours of some queries."""
    spark = placed.sparkSession
    queries = written(queries.select(key, "unit"), "trial")
    found = neighbours(
        spark, path, queries, key, "unit", TRIAL_NEIGHBOURS, probes=1, exact=True
    )
    found = written(found, "trial")
    cells = placed.select(key, "cell").join(F.broadcast(found), key).select("query", "cell")
    asked = {r[key]: r["unit"] for r in queries.collect()}
    centres = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()
    place = {c["cell"]: i for i, c in enumerate(centres)}
    centroids = np.array([c["centroid"] for c in centres])
    order = {q: np.argsort(np.argsort(-(centroids @ np.array(u)), kind="stable")) for q, u in asked.items()}
    ranks = np.sort([order[r["query"]][place[r["cell"]]] for r in cells.collect()])
    return int(ranks[max(0, int(np.ceil(recall * len(ranks))) - 1)]) + 1 if len(ranks) else 1


def neighbours(
    spark: SparkSession,
    path: str,
    queries: DataFrame,
    key: str,
    vector: str,
    k: int = 20,
    *,
    probes: int | None = None,
    exact: bool = False,
) -> DataFrame:
    """``(query, key, similarity)``: the ``k`` vectors nearest to each query by cosine.

    ``queries`` has a key and a vector; they may or may not be in the index. Looks into the
    ``probes`` cells nearest to a query (as many as the index says, unless given); with ``exact`` also into every other cell that can hold
    a vector as similar as the k-th found there. Ties go to the smaller key. Queries without a
    direction have no neighbours.

    Every query goes once to each part of its cells, and a task holds one part of a cell.
    """
    cells = spark.read.parquet(f"{path}/cells").orderBy("cell").collect()
    if not cells:
        schema = f"query {queries.schema[key].dataType.simpleString()}, "
        schema += f"{key} {queries.schema[key].dataType.simpleString()}, similarity double"
        return spark.createDataFrame([], schema)
    if probes is None:
        probes = spark.read.parquet(f"{path}/probes").first()["probes"]
    asked = written(unit_vectors(queries, key, vector), "asked")
    none = asked.withColumn("least", F.lit(None).cast("double"))
    found = _searched(spark, path, _sent(none, key, cells, probes, False), key, k)
    best = _best(found, key, k)
    if not exact:
        return best
    found = written(found, "found")
    least = _best(found, key, k).groupBy("query").agg(
        F.count(F.lit(1)).alias("n"), F.min("similarity").alias("least")
    )
    reached = least.select(F.col("query").alias(key), F.when(F.col("n") == k, F.col("least")).alias("least"))
    open_ = asked.join(reached, key, "left").withColumn("least", F.coalesce("least", F.lit(-2.0)))
    more = _searched(spark, path, _sent(open_, key, cells, probes, True), key, k)
    return _best(found.unionByName(more), key, k)


def _best(found: DataFrame, key: str, k: int) -> DataFrame:
    return top_n_per_key(found, ["query"], [F.desc("similarity"), F.asc(key)], k)


def _few_scores(batches: Iterator[pa.RecordBatch], cells: int) -> Iterator[pa.RecordBatch]:
    """The same rows, so few together that their similarities to all cells are ``SCORES`` at most."""
    step = max(1, SCORES // max(cells, 1))
    for batch in batches:
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def _sent(asked: DataFrame, key: str, cells: list, probes: int, further: bool) -> DataFrame:
    """``(key, unit, cell, part)``: each query to all parts of the cells it looks into.

    Those with the nearest centroids or, for ``further``, the others whose bound reaches ``least``.
    """
    numbers = np.array([c["cell"] for c in cells])
    centroids = np.array([c["centroid"] for c in cells])
    parts = np.array([c["parts"] for c in cells])
    radius = np.arccos(np.clip([c["near"] for c in cells], -1, 1))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _few_scores(batches, len(centroids)):
            cosine = np.clip(matrix(batch.column("unit")) @ centroids.T, -1, 1)
            order = np.argsort(-cosine, axis=1, kind="stable")
            wanted = np.zeros(cosine.shape, bool)
            np.put_along_axis(wanted, order[:, :probes], True, axis=1)
            if further:
                bound = np.cos(np.maximum(np.arccos(cosine) - radius, 0))
                least = batch.column("least").to_numpy(zero_copy_only=False)
                wanted = ~wanted & (bound >= least[:, None] - SLACK)
            rows, places = np.nonzero(wanted)
            ends = np.cumsum(parts[places])
            # A query goes to many cells: its vector is copied for a few rows at a time only.
            for start in range(0, int(ends[-1]) if len(ends) else 0, SENT_ROWS):
                number = np.arange(start, min(start + SENT_ROWS, int(ends[-1])))
                pair = np.searchsorted(ends, number, side="right")
                row, place = pa.array(rows[pair]), places[pair]
                part = number - (ends[pair] - parts[place])
                taken = [batch.column(c).take(row) for c in (key, "unit")]
                cell = pa.array(numbers[place], pa.int32())
                columns = [*taken, cell, pa.array(part, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, [key, "unit", "cell", "part"])

    more = T.StructType.fromDDL("cell int, part int").fields
    schema = T.StructType([asked.schema[key], asked.schema["unit"], *more])
    return asked.mapInArrow(chosen, schema)


def _searched(
    spark: SparkSession, path: str, sent: DataFrame, key: str, k: int
) -> DataFrame:
    """``(query, key, similarity)``: for each query and part the ``k`` best of that part.

    Vectors and queries of a part meet in one task, vectors first: the task holds these and lets
    the queries pass.
    """
    vectors = spark.read.parquet(f"{path}/vectors")
    columns = [key, "unit", "cell", "part"]
    wanted = sent.select("cell").distinct()
    stored = vectors.join(wanted, "cell", "left_semi")
    rows = stored.select(*columns, F.lit(0).alias("kind"))
    both = rows.unionByName(sent.select(*columns, F.lit(1).alias("kind")))
    dealt = both.repartition("cell", "part").sortWithinPartitions("cell", "part", "kind", key)

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = None, []
        for batch in batches:
            groups = [batch.column(c).to_numpy() for c in ("cell", "part", "kind")]
            change = np.flatnonzero(np.any([g[1:] != g[:-1] for g in groups], axis=0)) + 1
            for start, end in zip([0, *change], [*change, batch.num_rows], strict=True):
                run = batch.slice(start, end - start)
                here = tuple(int(g[start]) for g in groups[:2])
                if here != place:
                    place, held = here, []
                if groups[2][start] == 0:
                    held.append(run)
                elif held:
                    table = pa.Table.from_batches(held).combine_chunks()
                    held = table.to_batches()
                    yield from _scored(held[0], run, key, k)

    key_type = sent.schema[key].dataType
    schema = T.StructType([T.StructField("query", key_type), T.StructField(key, key_type)])
    return dealt.mapInArrow(searched, schema.add("similarity", "double"))


def _scored(rows: pa.RecordBatch, asked: pa.RecordBatch, key: str, k: int):
    vectors = matrix(rows.column("unit"))
    queries = matrix(asked.column("unit"))
    step = max(1, SCORES // len(vectors))
    for start in range(0, len(queries), step):
        cosine = queries[start : start + step] @ vectors.T
        rounded = np.floor(cosine * 10**DIGITS + 0.5) / 10**DIGITS
        at = min(k, len(vectors)) - 1
        least = -np.partition(-rounded, at, axis=1)[:, at]
        query, row = np.nonzero(rounded >= least[:, None])
        similarity = rounded[query, row]
        # Rows are sorted by key, so the earlier one is the smaller key.
        order = np.lexsort((row, -similarity, query))
        rank = np.arange(len(order)) - np.searchsorted(query[order], query[order])
        order = order[rank < k]
        yield pa.RecordBatch.from_arrays(
            [
                asked.column(key).take(pa.array(query[order] + start)),
                rows.column(key).take(pa.array(row[order])),
                pa.array(similarity[order]),
            ],
            ["query", key, "similarity"],
        )


def matrix(lists: pa.ListArray) -> np.ndarray:
    """Vectors of one length as rows."""
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(lists), -1) if len(lists) else np.zeros((0, 0))

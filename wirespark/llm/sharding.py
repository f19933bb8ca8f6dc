"""Contiguous shards of nearly equal size, from prefix sums of sizes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wirespark.llm.common import stored

LAW = "bytes"

_LOCAL = "copies string, doc_id bigint, size bigint, text_crc32 bigint, part int, bytes_before bigint, rows_before bigint"


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes and rows of the same partition before each row; only two numbers are carried on."""
    part, size, rows = TaskContext.get().partitionId(), 0, 0
    for batch in batches:
        n, sizes = len(batch), batch.column("size").to_numpy()
        ends = size + np.cumsum(sizes)
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns,
                pa.array(np.full(n, part, np.int32)),
                pa.array(ends - sizes),
                pa.array(np.arange(rows, rows + n)),
            ],
            names=[*batch.schema.names, "part", "bytes_before", "rows_before"],
        )
        size, rows = int(ends[-1]) if n else size, rows + n


def balanced_shards(docs: DataFrame, shards: int) -> DataFrame:
    """Put documents into contiguous shards whose byte sizes are nearly equal.

    ``docs`` needs doc_id and text; other columns are ignored. The size of a document is
    the bytes of its text in UTF-8 plus 1 (a null text has none). Documents are ordered by
    the MD5 of the text, then doc_id, so equal texts (and, among themselves, null texts) lie
    side by side. They are range-partitioned in that order, which also splits a text that
    many documents share; every partition reports its total, prefix sums over the totals give
    each partition its base, and base plus running sum gives each document its global place.
    A group of equal texts goes as a whole to the shard in whose equal part of the bytes its
    middle lies, so shards differ by at most the largest group. Repeated rows are
    kept. An empty table gives an empty result.

    Returns doc_id, size, text_crc32 (0 for null), law, shard, slot (0, 1, … within the
    shard, in order) and grown_shard (null: it belongs to another law).
    """
    text = F.col("text").cast("binary")
    rows = docs.select(
        F.coalesce(F.md5(text), F.lit("")).alias("copies"),
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.coalesce(F.crc32(text), F.lit(0)).cast("bigint").alias("text_crc32"),
    )
    ordered = rows.repartitionByRange("copies", "doc_id").sortWithinPartitions(
        F.asc("copies"), F.asc_nulls_first("doc_id")
    )
    local = stored(ordered.mapInArrow(_running, _LOCAL), "shard-order")
    # One row a partition: small however much data there is.
    totals = local.groupBy("part").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        "part",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base_bytes"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("base_rows"),
    )
    total = totals.agg(F.sum("size")).first()[0] or 1
    placed = local.join(F.broadcast(bases), "part").select(
        "copies",
        "doc_id",
        "size",
        "text_crc32",
        (F.col("base_bytes") + F.col("bytes_before")).alias("first_byte"),
        (F.col("base_rows") + F.col("rows_before")).alias("row"),
    )
    groups = placed.groupBy("copies").agg(
        F.min("first_byte").alias("first_byte"),
        F.sum("size").alias("bytes"),
        F.min("row").alias("row"),
    )
    middle = F.col("first_byte") * 2 + F.col("bytes")
    shard = F.least(F.floor(middle * shards / (2 * total)).cast("int"), F.lit(shards - 1))
    cuts = groups.groupBy(shard.alias("shard")).agg(F.min("row").alias("row"))
    # At most one row a shard. Later shards begin at later rows.
    starts = sorted(cuts.collect())
    shard, first = F.lit(0), F.lit(0).cast("bigint")
    for number, row in starts:
        reached = F.col("row") >= row
        shard = F.when(reached, F.lit(number)).otherwise(shard)
        first = F.when(reached, F.lit(row).cast("bigint")).otherwise(first)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        shard.cast("int").alias("shard"),
        (F.col("row") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

"""Substring search that reads few rows: an index of the trigrams in each block of rows.

Rows are laid out in a given order and cut into blocks; the index lists the blocks in which a
column holds each run of three characters. A pattern's literal runs give trigrams that a match must
hold, all in one column; only blocks with all of them are read, by a filter that reaches the scan,
and their rows are tested with the pattern itself. A pattern without a run of three characters is
tested on all rows. Both sides are in lower case, so the search does not regard case.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wirespark.functions.text import contains_ignoring_case
from wirespark.operators.postings import BLOCK_BITS, NAMED_BLOCKS, in_blocks

GRAM = 3


def write_trigrams(
    df: DataFrame, columns: Sequence[str], order: Sequence[str], path: str
) -> None:
    """Write the rows of ``df`` by ``order`` and the trigrams of their ``columns`` below ``path``.

    Rows that are alike should follow one another, so that a trigram stands in few blocks. The
    order should end in a key: rows are dealt by its ranges.
    """
    spark = df.sparkSession
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # The lower 33 bits of the id count the rows of a task, so its blocks are its own.
    block = F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS)
    dealt.withColumn("block", block).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    held = rows.select("block", F.inline_outer(F.array(*[_entry(c) for c in columns])))
    found = held.select("block", "place", F.explode_outer("grams").alias("gram"))
    listed = found.filter(F.col("gram").isNotNull()).distinct()
    by_gram = listed.repartitionByRange("gram", "place", "block")
    by_gram.sortWithinPartitions("gram", "place", "block").write.parquet(f"{path}/grams")


def _entry(column: str) -> Column:
    text = F.lower(F.coalesce(F.col(column), F.lit("")))
    starts = F.sequence(F.lit(1), F.length(text) - (GRAM - 1))
    grams = F.transform(starts, lambda i: F.substr(text, i, F.lit(GRAM)))
    enough = F.length(text) >= GRAM
    none = F.array().cast("array<string>")
    return F.struct(
        F.lit(column).alias("place"),
        F.when(enough, F.array_distinct(grams)).otherwise(none).alias("grams"),
    )


def literal_runs(pattern: str, *, literal: bool = False) -> list[str]:
    """The parts of a LIKE pattern between wildcards; all of it for ``literal``."""
    if literal:
        return [pattern] if pattern else []
    runs, taken = [""], False
    for c in pattern:
        if taken:
            runs[-1] += c
            taken = False
        elif c == "\\":
            taken = True
        elif c in "%_":
            runs.append("")
        else:
            runs[-1] += c
    return [run for run in runs if run]


def grams_of(runs: Sequence[str]) -> list[str]:
    """Distinct trigrams of the runs, in lower case."""
    lowered = [run.lower() for run in runs]
    return sorted({r[i : i + GRAM] for r in lowered for i in range(len(r) - GRAM + 1)})


def candidates(
    spark: SparkSession, path: str, columns: Sequence[str], runs: Sequence[str]
) -> DataFrame:
    """Rows of the blocks in which one of the ``columns`` holds all trigrams of the runs.

    All rows if the runs have none. A trigram may come from different rows of a block, so
    the rows are candidates only.
    """
    rows = spark.read.parquet(f"{path}/rows")
    grams = grams_of(runs)
    if not grams:
        return rows
    listed = spark.read.parquet(f"{path}/grams")
    listed = listed.filter(F.col("gram").isin(grams) & F.col("place").isin(list(columns)))
    # Each trigram is listed once for a block and column.
    held = listed.groupBy("block", "place").agg(F.count(F.lit(1)).alias("n"))
    able = held.filter(F.col("n") == len(grams)).select("block").distinct()
    blocks = [r["block"] for r in able.limit(NAMED_BLOCKS + 1).collect()]
    if len(blocks) <= NAMED_BLOCKS:
        return rows.filter(in_blocks(blocks))
    return rows.join(able, "block", "left_semi")


def containing(
    spark: SparkSession, path: str, columns: Sequence[str], text: str
) -> DataFrame:
    """Rows in which one of the indexed ``columns`` contains ``text`` literally, in any case."""
    rows = candidates(spark, path, columns, literal_runs(text, literal=True))
    found = [contains_ignoring_case(F.col(c), text) for c in columns]
    return rows.filter(reduce(or_, found, F.lit(False))).drop("block")


def matching(spark: SparkSession, path: str, column: str, pattern: str) -> DataFrame:
    """Rows whose indexed ``column`` contains a LIKE ``pattern``, in any case."""
    rows = candidates(spark, path, [column], literal_runs(pattern))
    return rows.filter(F.col(column).ilike(f"%{pattern}%")).drop("block")

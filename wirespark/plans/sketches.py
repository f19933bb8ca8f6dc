"""Counts of distinct values from sketches stored day by day.

A sketch (HyperLogLog, ``hll_sketch_agg``) of a day is some kilobytes whatever the day holds, and
sketches of days merge into that of all of them. So a new day is sketched once, and a count over
any range of days reads one row a day. ``stats`` and ``id_overlap`` give the exact figures.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wirespark.functions.text import list_items
from wirespark.operators.joins import exploded
from wirespark.schemas import NewsTables

#: Logarithm of a sketch's size.
LOG_K = 14
#: Bound of the relative error of a merged sketch, three standard errors.
RELATIVE_ERROR = 3 * 1.04 / math.sqrt(1 << LOG_K)

THEMES, EVENTS, MENTIONED, RECORDS = "themes", "events", "mentioned", "records"


def _day_of(stamp: Column) -> Column:
    return F.substring(stamp.cast("string"), 1, 8).try_cast("int")


def sketches(t: NewsTables) -> DataFrame:
    """``(name, day, rows, sketch)``: themes and ids of events, mentions and records by day.

    ``rows`` counts all rows, ``sketch`` the values that are not NULL. Rows without a readable
    day are under a NULL day. Tasks sketch what they read; only sketches are shuffled.
    """
    day = _day_of(F.col("date"))
    dated = t.gkg.select(F.struct(day.alias("day")).alias("key"), "themes")
    themes = exploded(dated, "key", list_items(F.col("themes")), "value").select("key.day", "value")
    named = {
        THEMES: themes,
        EVENTS: t.events.select(F.col("sqldate").alias("day"), F.col("globaleventid").alias("value")),
        MENTIONED: t.mentions.select(
            _day_of(F.col("mentiontimedate")).alias("day"), F.col("globaleventid").alias("value")
        ),
        RECORDS: t.gkg.select(day.alias("day"), F.col("gkgrecordid").alias("value")),
    }
    found = None
    for name, rows in named.items():
        counted = rows.groupBy("day").agg(
            F.count(F.lit(1)).alias("rows"), F.hll_sketch_agg("value", LOG_K).alias("sketch")
        )
        part = counted.select(F.lit(name).alias("name"), "day", "rows", "sketch")
        found = part if found is None else found.unionByName(part)
    return found


def write_sketches(t: NewsTables, folder: str, mode: str = "append") -> None:
    """Add the sketches of some rows, say those of a drop; a day may have several."""
    sketches(t).coalesce(1).write.mode(mode).parquet(folder)


def _stored(
    spark: SparkSession, folder: str, days: tuple[int, int] | None
) -> DataFrame:
    rows = spark.read.parquet(folder)
    return rows if days is None else rows.filter(F.col("day").between(*days))


def distinct_counts(
    spark: SparkSession, folder: str, days: tuple[int, int] | None = None
) -> DataFrame:
    """``(name, rows, distinct, error)`` over all days or those of a range (yyyymmdd, both in).

    ``rows`` is exact; ``distinct`` is off by ``error`` at most, but for about 3 in 1,000 cases.
    """
    merged = _stored(spark, folder, days).groupBy("name").agg(
        F.sum("rows").alias("rows"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"),
    )
    error = F.ceil(F.col("distinct") * RELATIVE_ERROR)
    return merged.withColumn("error", error)


def overlap(
    spark: SparkSession,
    folder: str,
    one: str = EVENTS,
    other: str = MENTIONED,
    days: tuple[int, int] | None = None,
) -> DataFrame:
    """``(distinct, error)``: values that both have, as the sum of both less their union."""
    rows = _stored(spark, folder, days).filter(F.col("name").isin(one, other))

    def estimate(test: Column) -> Column:
        union = F.hll_union_agg(F.when(test, F.col("sketch")))
        return F.coalesce(F.hll_sketch_estimate(union), F.lit(0))

    sizes = rows.agg(
        estimate(F.col("name") == one).alias("a"),
        estimate(F.col("name") == other).alias("b"),
        estimate(F.lit(True)).alias("both"),
    )
    shared = F.greatest(F.col("a") + F.col("b") - F.col("both"), F.lit(0))
    error = F.ceil((F.col("a") + F.col("b") + F.col("both")) * RELATIVE_ERROR)
    return sizes.select(shared.cast("bigint").alias("distinct"), error.alias("error"))

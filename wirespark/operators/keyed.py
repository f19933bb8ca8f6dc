"""Per-key and global selections with a total order.

Every order passed in here ends in tie-breakers, so results are repeatable.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SALT_BUCKETS = 64
# Up to this rank Spark drops rows of a window before its shuffle.
PRUNED_RANKS_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"
# Rows a caller-limited result may have to be broadcast without asking its size.
BROADCAST_ROWS = 10_000

_RANK = "_rank"
_SALT = "_salt"
_COPIES = "_copies"


def distinct_on(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key (NULL keys form one group).

    Each task keeps one row per key before the shuffle, so a hot key reaches
    its reducer as at most one row per task.
    """
    return top_n_per_key(df, keys, order, 1)


def top_n_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int
) -> DataFrame:
    """First ``n`` rows per key.

    For large ``n``, equal rows are counted first, so a group of copies travels as
    one row, and distinct rows go through a salted pass, which spreads a hot key
    over ``SALT_BUCKETS`` tasks and leaves at most that many times ``n`` rows of it.
    """
    if n <= _pruned_ranks(df):
        return _ranked(df, keys, order, n)
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(_COPIES))
    salted = counted.withColumn(_SALT, F.pmod(F.xxhash64(*df.columns), F.lit(SALT_BUCKETS)))
    kept = _ranked(salted, [*keys, _SALT], order, n)
    earlier = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(_COPIES).over(earlier), F.lit(0))
    placed = kept.withColumn(_RANK, before).filter(F.col(_RANK) < n)
    copies = F.least(F.col(_COPIES), F.lit(n) - F.col(_RANK)).cast("int")
    return placed.select(*df.columns, F.explode(F.array_repeat(F.lit(1), copies))).drop("col")


def _pruned_ranks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(PRUNED_RANKS_CONF))


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) <= n).drop(_RANK)
    )


def top_n(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """First ``n`` rows of the whole frame; each task forwards only its own first ``n``."""
    return df.orderBy(*order).limit(n)


def top_n_merged(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """``top_n`` for large ``n`` over many tasks.

    One task cannot take ``n`` rows from each of very many tasks. Here every task
    sorts and keeps its first ``n``, as many tasks as the square root of the session's
    shuffle partitions do the same for what they are sent, and the last one takes at
    most ``n`` rows from each of those.
    """
    if n <= _pruned_ranks(df):
        return top_n(df, n, order)
    tasks = math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))) + 1
    merged = _first_per_task(df, n, order).repartition(tasks)
    return top_n(_first_per_task(merged, n, order), n, order)


def _first_per_task(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    # The lower 33 bits of the id count the rows of a task.
    position = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    ranked = df.sortWithinPartitions(*order).withColumn(_RANK, position)
    return ranked.filter(F.col(_RANK) < n).drop(_RANK)


def small(df: DataFrame, rows: int | None) -> DataFrame:
    """Broadcast a frame whose row count the caller has limited to ``rows``.

    Beyond ``BROADCAST_ROWS``, or without a limit, the hint is left out and the join is Spark's choice.
    """
    return F.broadcast(df) if rows is not None and rows <= BROADCAST_ROWS else df


def facet(df: DataFrame, column: str, n: int, name: str | None = None) -> DataFrame:
    """The ``n`` most frequent non-empty values with their counts."""
    name = name or column
    counts = (
        df.filter(F.col(column).isNotNull() & (F.col(column) != ""))
        .groupBy(F.col(column).alias(name))
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return top_n(counts, n, [F.desc("count"), F.asc(name)])

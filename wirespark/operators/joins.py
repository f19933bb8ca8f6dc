"""Joins that keep hot keys splittable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPREAD = "_spread"


def lookup_join(
    left: DataFrame, right: DataFrame, on: str | Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join of a possibly skewed left side with a right side reduced per key.

    A right side that comes straight out of a ``groupBy`` or window on the key is
    already partitioned by it, and Spark then joins it without an exchange of its
    own. Adaptive execution splits a hot partition only where both inputs of the
    join are exchanges. Joining on the key and a hash of it as well gives the
    (reduced) right side its own exchange, so a hot left key is split over tasks.
    """
    keys = [on] if isinstance(on, str) else list(on)

    def keyed(df: DataFrame) -> DataFrame:
        return df.withColumn(_SPREAD, F.xxhash64(*keys))

    return keyed(left).join(keyed(right), [*keys, _SPREAD], how).drop(_SPREAD)


def pair_count(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Row count of an inner equi-join, as one row ``(count)``, without forming the pairs."""
    a = left.groupBy(F.col(left_key).alias("_key")).agg(F.count(F.lit(1)).alias("_left"))
    b = right.groupBy(F.col(right_key).alias("_key")).agg(F.count(F.lit(1)).alias("_right"))
    pairs = F.sum(F.col("_left") * F.col("_right"))
    return a.join(b, "_key").agg(F.coalesce(pairs, F.lit(0)).alias("count"))


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key is set but has no parent (foreign-key check)."""
    known = parent.select(F.col(parent_key).alias(child_key)).distinct()
    return lookup_join(child.filter(F.col(child_key).isNotNull()), known, child_key, "left_anti")


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their counts (primary-key check)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("count")).filter(F.col("count") > 1)


def exploded(df: DataFrame, key: str, items, name: str) -> DataFrame:
    """One row per item of an array expression, next to its record key.

    Outer form plus filter, so that the array is computed once per row (the plain
    form makes Spark infer a size filter on it, which computes it a second time).
    """
    return df.select(key, F.explode_outer(items).alias(name)).filter(F.col(name).isNotNull())

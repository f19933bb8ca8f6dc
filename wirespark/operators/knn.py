"""Nearest neighbours by cosine on a vector column."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirespark.operators.keyed import top_n

DIGITS = 6


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine(a: Column, b: Column) -> Column:
    return _dot(a, b) / F.sqrt(_dot(a, a) * _dot(b, b))


def nearest_vectors(
    df: DataFrame, key: str, vector: str, target: Column, k: int = 20
) -> DataFrame:
    """The ``k`` rows closest to ``target``: ``(key, similarity)``.

    ``target`` is a constant or a scalar subquery, so rows are scored where they
    are read and every task forwards only its own best ``k``.
    """
    similarity = F.round(cosine(F.col(vector), F.col("_target")), DIGITS)
    rows = df.select(key, vector, target.alias("_target"))
    scored = rows.select(key, similarity.alias("similarity"))
    return top_n(scored, k, [F.desc_nulls_last("similarity"), F.asc(key)])


def mean_vector(df: DataFrame, vector: str) -> Column:
    """Component-wise mean of a vector column, as a scalar subquery."""
    means = df.select(F.posexplode(vector)).groupBy("pos").agg(F.avg("col").alias("mean"))
    ordered = F.array_sort(F.collect_list(F.struct("pos", "mean")))
    return means.agg(F.transform(ordered, lambda e: e["mean"])).scalar()

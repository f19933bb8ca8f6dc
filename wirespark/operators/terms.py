"""Term counts of documents, computed inside each row."""

from __future__ import annotations

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def english_stop_words() -> list[str]:
    return StopWordsRemover.loadDefaultStopWords("english")


def with_term_counts(df: DataFrame, tokens: Column, name: str = "terms") -> DataFrame:
    """Add ``name``: array of (term, tf) for the token array of each row.

    Tokens are sorted within the row and runs counted, so no shuffle is needed
    and rows stay apart even where their ids repeat.
    """
    size = F.size("_sorted")
    new_run = F.filter(
        F.sequence(F.lit(0), size - 1),
        lambda i: (i == 0) | (F.get("_sorted", i) != F.get("_sorted", i - 1)),
    )
    no_runs = F.array().cast("array<int>")
    counts = F.transform(
        "_runs",
        lambda start, k: F.struct(
            F.get("_sorted", start).alias("term"),
            (F.coalesce(F.get("_runs", k + 1), size) - start).cast("bigint").alias("tf"),
        ),
    )
    return (
        df.withColumn("_sorted", F.sort_array(tokens))
        .withColumn("_runs", F.when(size > 0, new_run).otherwise(no_runs))
        .withColumn(name, counts)
        .drop("_sorted", "_runs")
    )


def exploded_terms(df: DataFrame, key: str, terms: str = "terms") -> DataFrame:
    """Inverted index rows ``(key, term, tf)``.

    The outer form with a filter behind it is deliberate: for the plain form Spark
    infers a size filter on the array, pushes it below the projections that build
    the array and so evaluates them again inside one another.
    """
    return df.select(key, F.inline_outer(terms)).filter(F.col("term").isNotNull())

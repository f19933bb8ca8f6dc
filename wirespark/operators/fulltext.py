"""Full-text match and rank with stop words and the S-stemmer.

Stemming is lighter than a dictionary-backed English configuration, so ranks
can differ from it in detail. The rank is cover density for words joined by OR:
every matching token is a cover of length one and adds the default weight 0.1.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wirespark.functions.text import joined_text, search_tokens
from wirespark.operators.terms import english_stop_words, exploded_terms, with_term_counts

TOKEN_WEIGHT = 0.1


def query_terms(spark: SparkSession, query: str, stop_words: list[str] | None = None) -> list[str]:
    """Distinct search terms of a query, by the same analysis as documents."""
    if not query:
        raise ValueError("search text is required")
    tokens = search_tokens(F.lit(query), stop_words or english_stop_words())
    return spark.range(1).select(F.array_distinct(tokens).alias("t")).first()["t"]


def inverted_index(
    df: DataFrame, key: str, text: Column, stop_words: list[str] | None = None
) -> DataFrame:
    """Rows ``(key, term, tf)``, one per document and distinct term."""
    tokens = search_tokens(F.col("_text"), stop_words or english_stop_words())
    return exploded_terms(with_term_counts(df.select(key, text.alias("_text")), tokens), key)


def rank_index(index: DataFrame, key: str, terms: list[str]) -> DataFrame:
    """Matching documents ``(key, rank)`` from an index."""
    return (
        index.filter(F.col("term").isin(terms))
        .groupBy(key)
        .agg(F.round(F.sum("tf") * TOKEN_WEIGHT, 6).alias("rank"))
    )


def rank_rows(
    df: DataFrame, text: Column, terms: list[str], stop_words: list[str] | None = None
) -> DataFrame:
    """Matching rows of ``df`` with their ``rank``, without an index or a shuffle.

    A row can only match if it contains the unchanging part of a term, and rows
    that do not are dropped before they are tokenised.
    """
    lowered = F.lower(text)
    fixed = [F.contains(lowered, F.lit(_fixed_part(term))) for term in terms]
    possible = reduce(or_, fixed, F.lit(False))
    tokens = search_tokens(text, stop_words or english_stop_words())
    hits = F.size(F.filter(tokens, lambda token: token.isin(terms)))
    return (
        df.filter(possible)
        .withColumn("rank", F.round(hits * TOKEN_WEIGHT, 6))
        .filter(F.col("rank") > 0)
    )


def _fixed_part(term: str) -> str:
    """What every word form of a stem contains: stories -> story, so 'stor'."""
    return term[:-1] if term.endswith("y") else term


def record_text(title: Column) -> Column:
    """Searchable text of an article record."""
    lists = [F.col(c) for c in ("themes", "persons", "organizations", "allnames")]
    return joined_text(*lists, title)

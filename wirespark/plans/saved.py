"""Filters over saved indexes: the queries of ``news`` without a scan of all texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirespark.operators import trigrams
from wirespark.plans.news import all_articles, news_of_records
from wirespark.schemas import NewsTables

SEARCHED = ["title", "actor1_name", "actor2_name", "theme"]


def write_text_indexes(t: NewsTables, folder: str) -> None:
    """Save articles and themes with the trigrams of their texts.

    ``folder/articles`` holds every article by source and title, ``folder/themes`` every theme of
    every record by theme.
    """
    articles = all_articles(t)
    first = ["source", "title", "id"]
    order = [*first, *[c for c in articles.columns if c not in first]]
    trigrams.write_trigrams(articles, [*SEARCHED, "source"], order, f"{folder}/articles")
    themes = t.gkg_themes.select("gkgrecordid", "theme")
    trigrams.write_trigrams(themes, ["theme"], ["theme", "gkgrecordid"], f"{folder}/themes")


def contains_search(spark: SparkSession, folder: str, text: str) -> DataFrame:
    """``news.contains_search`` over all saved articles."""
    if not text:
        raise ValueError("search text is required")
    return trigrams.containing(spark, f"{folder}/articles", SEARCHED, text)


def source_filter(spark: SparkSession, folder: str, source: str = "All") -> DataFrame:
    """``news.source_filter`` over all saved articles."""
    path = f"{folder}/articles"
    if source == "All":
        return spark.read.parquet(f"{path}/rows").drop("block")
    return trigrams.containing(spark, path, ["source"], source)


def filter_news(
    t: NewsTables, folder: str, theme: str, limit: int = 50, *, literal: bool = False
) -> DataFrame:
    """``news.filter_news`` with the records of a theme from the saved index."""
    if not theme:
        raise ValueError("theme is required")
    spark, path = t.gkg.sparkSession, f"{folder}/themes"
    if literal:
        found = trigrams.containing(spark, path, ["theme"], theme)
    else:
        found = trigrams.matching(spark, path, "theme", theme)
    return news_of_records(t, found.select("gkgrecordid").distinct(), limit)

"""Batch jobs: landed feed files to clean tables, and clean tables to their stores."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirespark.functions.text import clean_name, list_items
from wirespark.operators.joins import exploded
from wirespark.operators.keyed import distinct_on
from wirespark.plans.search import search_docs, search_table
from wirespark.schemas import BASE_TABLES, CHILD_TABLES, NewsTables
from wirespark.sinks.writers import write_clean
from wirespark.sources import feeds
from wirespark.sources.archives import read_archives
from wirespark.sources.tables import read_clean, read_news_tables


def child_table(gkg: DataFrame, table: str) -> DataFrame:
    """Items of one list column, one row each, next to the record id."""
    column, item = CHILD_TABLES[table]
    return exploded(gkg, "gkgrecordid", list_items(F.col(column)), item)


def child_names(gkg: DataFrame) -> DataFrame:
    """``gkg_names`` with the names freed of their offsets."""
    return child_table(gkg, "gkg_names").withColumn("clean_name", clean_name(F.col("name")))


def unique_events(events: DataFrame) -> DataFrame:
    """Events with an id, the first added row of each; queries rely on unique ids."""
    order = [F.asc_nulls_last(c) for c in ["dateadded", *events.columns]]
    return distinct_on(events.filter(F.col("globaleventid").isNotNull()), ["globaleventid"], order)


def news_tables(events: DataFrame, mentions: DataFrame, gkg: DataFrame) -> NewsTables:
    """All seven relations from the three base tables."""
    children = {table: child_table(gkg, table) for table in CHILD_TABLES}
    return NewsTables(events=events, mentions=mentions, gkg=gkg, **children)


def landed_tables(spark: SparkSession, extract_dir: str, *, zipped: bool = False) -> NewsTables:
    """Relations over the folders ``export``, ``mentions`` and ``gkg`` of landed files."""

    def read(feed: str) -> DataFrame:
        path = f"{extract_dir}/{feed}"
        raw = read_archives(spark, path, feed) if zipped else feeds.read_raw(spark, path, feed)
        return feeds.typed(raw, feed)

    return news_tables(**{table: read(feed) for table, feed in BASE_TABLES.items()})


def transform(
    spark: SparkSession,
    extract_dir: str,
    out_dir: str,
    *,
    zipped: bool = False,
    fmt: str = "parquet",
    by_day: bool = False,
) -> NewsTables:
    """Clean landed files into one folder per table and return the tables read back.

    ``by_day`` lays the base tables out by day, for feeds large enough to fill files
    per day. Events delivered more than once are kept once. Base tables are written
    first and the list columns exploded from the written gkg table, so the raw files
    are parsed once.
    """
    landed = landed_tables(spark, extract_dir, zipped=zipped)
    base = {"events": unique_events(landed.events), "mentions": landed.mentions, "gkg": landed.gkg}
    for table, df in base.items():
        write_clean(df, out_dir, table, fmt, by_day=by_day)
    stored = _stored_tables(spark, out_dir, fmt)
    for table in CHILD_TABLES:
        write_clean(getattr(stored, table), out_dir, table, fmt)
    return read_news_tables(spark, out_dir, fmt)


def _stored_tables(spark: SparkSession, base: str, fmt: str) -> NewsTables:
    """Relations over stored base tables, with the children derived from gkg."""
    return news_tables(**{table: read_clean(spark, base, table, fmt) for table in BASE_TABLES})


def build_search_tables(t: NewsTables, out_dir: str) -> None:
    """Save ``search_docs`` (records with their terms) and ``search_terms`` (index).

    The index is laid out by term, so a query reads the row groups of its terms only.
    """
    write_clean(search_table(t.gkg), out_dir, "search_docs")
    index = search_docs(t.gkg).repartitionByRange("term", "gkgrecordid")
    write_clean(index.sortWithinPartitions("term"), out_dir, "search_terms")

"""The details of one article from tables laid out by key.

Each table is sorted by the column that a look-up names and carries Bloom filters on it, so the
filter of a look-up leaves few row groups of few files to read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirespark.plans.detail import news_detail
from wirespark.schemas import CHILD_TABLES, TABLE_NAMES, NewsTables, table_schema
from wirespark.stores.keyed_log import bloom_filter, one_of

#: Column that look-ups in a table name.
KEYS = {
    "events": "globaleventid",
    "mentions": "globaleventid",
    "gkg": "documentidentifier",
    **{table: "gkgrecordid" for table in CHILD_TABLES},
}
#: Keys that a filter names; with more, tables are joined.
NAMED_KEYS = 200


def write_lookup(t: NewsTables, folder: str, options: dict[str, str] | None = None) -> None:
    """Write all relations laid out by their keys.

    Rows are dealt by ranges of the key and of what else the table holds, so a key with very many
    rows is spread over files.
    """
    for table, df in t.named().items():
        key, names = KEYS[table], table_schema(table).names
        others = [n for n in ("mentionidentifier", "gkgrecordid", *names[1:2]) if n in names and n != key]
        dealt = df.select(*names).repartitionByRange(key, *others).sortWithinPartitions(key, *others)
        named = {key, "gkgrecordid"} & set(names)
        filters = {k: v for name in named for k, v in bloom_filter(name).items()}
        writer = dealt.write.options(**filters, **(options or {}))
        writer.parquet(f"{folder}/{table}")


def _named(df: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose key is among those of ``wanted``: by name if these are few."""
    values = [r[0] for r in wanted.filter(F.col(key).isNotNull()).limit(NAMED_KEYS + 1).collect()]
    if len(values) <= NAMED_KEYS:
        return df.filter(one_of(F.col(key), values))
    return df.join(wanted, key, "left_semi")


def tables_of(spark: SparkSession, folder: str, news_id: str, *, link: str = "url") -> NewsTables:
    """The rows of all relations that belong to one event and its articles."""
    t = {
        table: spark.read.schema(table_schema(table)).parquet(f"{folder}/{table}")
        for table in TABLE_NAMES
    }
    for table in ("events", "mentions"):
        t[table] = t[table].filter(F.col("globaleventid") == news_id)
    if link == "url":
        urls = t["events"].select(F.col("sourceurl").alias("documentidentifier")).distinct()
        t["gkg"] = _named(t["gkg"], "documentidentifier", urls)
    else:
        t["gkg"] = t["gkg"].filter(F.col("gkgrecordid") == news_id)
    records = t["gkg"].select("gkgrecordid").distinct()
    for table in CHILD_TABLES:
        t[table] = _named(t[table], "gkgrecordid", records)
    return NewsTables(**t)


def detail_of(
    spark: SparkSession,
    folder: str,
    news_id: str,
    *,
    tag: str = "PAGE_TITLE",
    link: str = "url",
) -> DataFrame:
    """``detail.news_detail`` of one event over tables of ``write_lookup``."""
    if not news_id:
        raise ValueError("news id is required")
    if link not in ("url", "id"):
        raise ValueError(f"unknown link: {link}")
    return news_detail(tables_of(spark, folder, news_id, link=link), news_id, tag=tag, link=link)

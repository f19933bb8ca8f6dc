"""News tables derived from the star-schema test tables.

Formulas are the fixed mapping of FIXTURES.md. Row counts enter as scalar
subqueries, so every join below is an equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wirespark.functions.dates import stamp
from wirespark.functions.text import list_items
from wirespark.operators.joins import exploded
from wirespark.schemas import CHILD_TABLES, NewsTables


# Declared, so that building a plan opens no file.
TABLE_SCHEMAS = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "pages": "page_id bigint, url string, html string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _row_count(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def _text(*parts) -> Column:
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def derived_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    source = read_table(spark, sf_dir, "events")
    eid, user = F.col("event_id"), F.col("user_id")
    codes = {"click": "010", "error": "042", "purchase": "061", "signup": "111"}
    code = F.lit(None).cast("string")
    for kind, value in codes.items():
        code = F.coalesce(code, F.when(F.col("event_type") == kind, F.lit(value)))
    code = F.coalesce(code, F.lit("190"))
    events = source.select(
        (eid % _row_count(pages)).alias("page_id"),
        eid.cast("string").alias("globaleventid"),
        F.date_format("ts", "yyyyMMdd").cast("int").alias("sqldate"),
        F.when(user % 5 != 0, _text("ACTOR_", user % 40)).alias("actor1name"),
        F.when(eid % 3 != 0, _text("ACTOR_", eid % 40)).alias("actor2name"),
        code.alias("eventcode"),
        code.alias("eventbasecode"),
        F.substring(code, 1, 2).alias("eventrootcode"),
        (F.lit(1) + eid % 4).cast("int").alias("quadclass"),
        ((eid % 21).cast("double") - 10).alias("goldsteinscale"),
        F.get_json_object("props", "$.k").cast("int").alias("nummentions"),
        F.when(eid % 17 != 0, F.col("value") - 100).alias("avgtone"),
        *[
            ((eid % span).cast("double") - span // 2).alias(f"{place}_{axis}")
            for place in ("actor1geo", "actor2geo", "actiongeo")
            for axis, span in (("lat", 181), ("long", 361))
        ],
        stamp(F.col("ts")).cast("bigint").alias("dateadded"),
    )
    urls = pages.select("page_id", F.col("url").alias("sourceurl"))
    return events.join(urls, "page_id").drop("page_id")


def derived_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_table(spark, sf_dir, "lineitem")
    return lines.select(
        F.col("l_orderkey").cast("string").alias("globaleventid"),
        stamp(F.col("l_shipdate")).cast("bigint").alias("mentiontimedate"),
        _text("src", F.col("l_suppkey") % 20).alias("mentionssource"),
        _text("http://m.example.com/", F.col("l_partkey"), "/", F.col("l_linenumber")).alias(
            "mentionidentifier"
        ),
        F.when(F.col("l_linenumber") != 7, F.col("l_quantity") * 2).alias("confidence"),
    )


def derived_gkg(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    docs = read_table(spark, sf_dir, "documents")
    part = read_table(spark, sf_dir, "part")
    pid = F.col("page_id")
    theme = _text(F.col("p_type"), "_", F.replace(F.col("p_brand"), F.lit("#"), F.lit("_")), ";")
    # Titles are taken out before the joins, so the pages themselves take no exchange.
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    joined = (
        pages.select("page_id", "url", title.alias("title"))
        .withColumn("doc_key", pid % _row_count(docs))
        .withColumn("part_a", pid % _row_count(part))
        .withColumn("part_b", (pid * 7 + 3) % _row_count(part))
        .join(docs.select(F.col("doc_id").alias("doc_key"), "source"), "doc_key", "left")
        .join(
            part.select(
                F.col("p_partkey").alias("part_a"), theme.alias("theme_a"), F.col("p_name")
            ),
            "part_a",
            "left",
        )
        .join(
            part.select(F.col("p_partkey").alias("part_b"), theme.alias("theme_b")),
            "part_b",
            "left",
        )
    )
    return joined.select(
        _text("20240101000000-", pid).alias("gkgrecordid"),
        _text("20240101", F.lpad((pid % 24).cast("string"), 2, "0"), "0000").alias("date"),
        F.when(pid % 11 != 0, F.col("source")).alias("sourcecommonname"),
        F.col("url").alias("documentidentifier"),
        F.when(pid % 13 != 0, F.concat("theme_a", "theme_b")).alias("themes"),
        F.when(pid % 7 == 0, F.lit(""))
        .otherwise(_text("person ", pid % 17, "; ;person ", pid % 23))
        .alias("persons"),
        _text("org ", pid % 29, ";org ", pid % 5, ";").alias("organizations"),
        _text("Name ", pid % 31, ",", pid, ";", F.col("p_name"), ",7").alias("allnames"),
        F.when(pid % 4 != 0, _text("http://img.example.com/", pid, ".jpg")).alias("sharingimage"),
        F.lit(None).cast("string").alias("relatedimages"),
        F.when(pid % 19 == 0, F.lit("<X>none</X>"))
        .otherwise(_text("<PAGE_TITLE>", F.col("title"), "</PAGE_TITLE>"))
        .alias("extras"),
    )


def derived_tables(spark: SparkSession, sf_dir: str) -> NewsTables:
    """All seven relations over the tables in ``sf_dir``."""
    gkg = derived_gkg(spark, sf_dir)
    children = {
        table: exploded(gkg, "gkgrecordid", list_items(F.col(column)), item)
        for table, (column, item) in CHILD_TABLES.items()
    }
    return NewsTables(
        events=derived_events(spark, sf_dir),
        mentions=derived_mentions(spark, sf_dir),
        gkg=gkg,
        **children,
    )

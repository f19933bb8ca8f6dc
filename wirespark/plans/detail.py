"""Article detail: event, article attributes, item lists and mean confidence."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wirespark.functions.text import tag_text
from wirespark.operators.joins import lookup_join
from wirespark.plans.news import DEFAULT_TITLE
from wirespark.schemas import NewsTables

LISTS = [
    ("themes", "gkg_themes", "theme"),
    ("persons", "gkg_persons", "person"),
    ("organizations", "gkg_organizations", "organization"),
]
ATTRIBUTES = ["documentidentifier", "sourcecommonname", "sharingimage", "extras"]


def news_detail(
    t: NewsTables,
    news_id: str | None = None,
    *,
    tag: str = "PAGE_TITLE",
    link: str = "url",
) -> DataFrame:
    """Details of one event, or of every event when ``news_id`` is None.

    An article is the set of records that agree in ``ATTRIBUTES``. Each item list
    is made distinct and concatenated per article before it is joined, so themes,
    persons, organizations and mentions never multiply one another. ``link='url'``
    finds articles by source URL; ``link='id'`` takes the event id as record id.
    """
    if news_id == "":
        raise ValueError("news id is required")
    if link not in ("url", "id"):
        raise ValueError(f"unknown link: {link}")
    events, mentions = t.events, t.mentions
    gkg = t.gkg
    event_key = "sourceurl" if link == "url" else "globaleventid"
    record_key = "documentidentifier" if link == "url" else "gkgrecordid"
    if news_id is not None:
        events = events.filter(F.col("globaleventid") == news_id)
        mentions = mentions.filter(F.col("globaleventid") == news_id)
        wanted = events.select(F.col(event_key).alias(record_key)).distinct()
        gkg = lookup_join(gkg, wanted, record_key, "left_semi")

    identity = ATTRIBUTES if link == "url" else ["gkgrecordid", *ATTRIBUTES]
    keyed = gkg.filter(F.col(record_key).isNotNull()).withColumn(
        "article", F.sha2(F.to_json(F.struct(*identity)), 256)
    )
    articles = keyed.select("article", F.col(record_key).alias("link"), *ATTRIBUTES)
    articles = articles.dropDuplicates(["article"])
    members = keyed.select("gkgrecordid", "article").distinct()
    for plural, table, item in LISTS:
        items = getattr(t, table).select("gkgrecordid", item)
        values = lookup_join(items, members, "gkgrecordid").select("article", item).distinct()
        joined = F.expr(f"listagg({item}, ', ') WITHIN GROUP (ORDER BY {item})")
        lists = values.groupBy("article").agg(joined.alias(plural))
        articles = articles.join(lists, "article", "left")

    means = mentions.groupBy("globaleventid").agg(F.avg("confidence").alias("avg_confidence"))
    described = events.select(
        F.col("globaleventid").alias("id"),
        F.col("sqldate").alias("date"),
        F.col("actor1name").alias("actor1_name"),
        F.col("actor2name").alias("actor2_name"),
        F.col("nummentions").alias("num_mentions"),
        F.col("goldsteinscale").alias("goldstein_scale"),
        F.col("avgtone").alias("avg_tone"),
        F.col(event_key).alias("link"),
    ).join(means.withColumnRenamed("globaleventid", "id"), "id", "left")
    return lookup_join(described, articles, "link", "left").select(
        "id",
        "date",
        "actor1_name",
        "actor2_name",
        "num_mentions",
        "goldstein_scale",
        "avg_tone",
        F.col("sourcecommonname").alias("source"),
        F.col("sharingimage").alias("image"),
        F.col("documentidentifier").alias("document_url"),
        F.coalesce(tag_text(F.col("extras"), tag), F.lit(DEFAULT_TITLE)).alias("title"),
        "themes",
        "persons",
        "organizations",
        "avg_confidence",
    )

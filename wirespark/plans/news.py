"""News queries over the seven relations.

All of them relate events to articles by URL and to mentions by event id. The
textbook form joins the three tables and removes duplicates afterwards; rows then
multiply by the mentions of an event and the records of a URL. Here each side is
reduced to what the ranking can still use before it is joined, which gives the
same rows: within an event the mention choice does not depend on the article
record, and the other way round.

Ties the ranking leaves open are settled by event id, confidence, record id and
then the remaining output columns. NULLs sort first in descending order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirespark.functions.dates import int_date
from wirespark.functions.text import contains_ignoring_case, first_item, tag_text
from wirespark.operators.expand import expanded, first_children
from wirespark.operators.joins import lookup_join
from wirespark.operators.keyed import distinct_on, small, top_n, top_n_merged
from wirespark.schemas import NewsTables
from wirespark.session import settled

DEFAULT_TITLE = "News Article"

EVENT_COLUMNS = [
    "globaleventid",
    "actor1name",
    "actor2name",
    "dateadded",
    "event_date",
    "eventcode",
    "nummentions",
    "avgtone",
    "sourceurl",
]
STORY = ["avgtone", "eventcode", "actor"]
RECORD_COLUMNS = ["gkgrecordid", "sourcecommonname", "first_theme", "sharingimage", "page_title"]


def desc(column: Column | str) -> Column:
    return F.desc_nulls_first(column)


def asc(column: Column | str) -> Column:
    return F.asc_nulls_last(column)


def record_order() -> list[Column]:
    return [asc(c) for c in RECORD_COLUMNS]


def _events(events: DataFrame) -> DataFrame:
    return events.withColumn("event_date", int_date(F.col("sqldate"))).select(*EVENT_COLUMNS)


def article_records(gkg: DataFrame, *extra: str) -> DataFrame:
    """Article records under their URL, without the long text columns."""
    return gkg.select(
        F.col("documentidentifier").alias("sourceurl"),
        "gkgrecordid",
        "sourcecommonname",
        first_item(F.col("themes")).alias("first_theme"),
        "sharingimage",
        tag_text(F.col("extras")).alias("page_title"),
        *extra,
    )


def strongest_confidence(mentions: DataFrame) -> DataFrame:
    """Per event the confidence of greatest magnitude (positive before negative)."""
    bounds = mentions.groupBy("globaleventid").agg(
        F.max("confidence").alias("high"), F.min("confidence").alias("low")
    )
    strongest = F.when(F.col("high") >= -F.col("low"), F.col("high")).otherwise(F.col("low"))
    return bounds.select("globaleventid", strongest.alias("confidence"))


def _highest_confidence(mentions: DataFrame) -> DataFrame:
    """Per event the greatest confidence; NULL where no mention has one."""
    return mentions.groupBy("globaleventid").agg(F.max("confidence").alias("confidence"))


def to_article(df: DataFrame, *extra: str) -> DataFrame:
    """The 12 article fields."""
    return df.select(
        F.col("globaleventid").alias("id"),
        F.col("actor1name").alias("actor1_name"),
        F.col("actor2name").alias("actor2_name"),
        "event_date",
        F.col("nummentions").alias("num_mentions"),
        F.col("avgtone").alias("avg_tone"),
        "confidence",
        F.col("sourceurl").alias("source_url"),
        F.col("sourcecommonname").alias("source"),
        F.col("first_theme").alias("theme"),
        F.col("sharingimage").alias("image"),
        F.col("page_title").alias("title"),
        *extra,
    )


def imaged_urls(gkg: DataFrame) -> DataFrame:
    return (
        gkg.filter(F.col("sharingimage").isNotNull())
        .select(F.col("documentidentifier").alias("sourceurl"))
        .distinct()
    )


def rankable_events(events: DataFrame) -> DataFrame:
    return _events(events).filter((F.col("nummentions") > 0) & F.col("avgtone").isNotNull())


def strength_order() -> list[Column]:
    """Which event stands for its story, and which story for its URL."""
    strength = [desc("nummentions"), desc(F.abs("confidence")), desc("avgtone")]
    return [*strength, asc("globaleventid"), desc("confidence")]


def top_order() -> list[Column]:
    strength = [desc("nummentions"), desc("avgtone"), desc(F.abs("confidence"))]
    return [*strength, asc("globaleventid"), desc("confidence")]


def top_news(t: NewsTables, limit: int = 5000) -> DataFrame:
    """Most mentioned news: one per (tone, code, actor), then one per URL.

    Ranking needs event columns and the strongest confidence only, so titles,
    images and themes are fetched for the ``limit`` winners alone.
    """
    events = rankable_events(t.events)
    confidences = strongest_confidence(t.mentions.filter(F.col("confidence").isNotNull()))
    scored = lookup_join(
        events.join(confidences, "globaleventid"), imaged_urls(t.gkg), "sourceurl", "left_semi"
    ).withColumn("actor", F.coalesce("actor1name", "actor2name"))
    per_story = distinct_on(scored, STORY, strength_order())
    per_url = distinct_on(per_story, ["sourceurl"], strength_order())
    order = top_order()
    winners = top_n_merged(per_url, limit, order)
    records = article_records(t.gkg.filter(F.col("sharingimage").isNotNull()))
    detailed = distinct_on(
        records.join(small(winners, limit), "sourceurl"), ["sourceurl"], record_order()
    )
    return to_article(top_n(detailed, limit, order))


def featured_news(t: NewsTables, limit: int = 1) -> DataFrame:
    """Rows of events with mentions and a pictured article, by (mentions / 3) x tone.

    Not deduplicated: an event gives a row per mention and article record.
    """
    score = (F.col("nummentions") / F.lit(3.0)) * F.col("avgtone")
    events = (
        _events(t.events)
        .filter((F.col("nummentions") > 0) & F.col("avgtone").isNotNull())
        .withColumn("score", score)
    )
    mentioned = events.join(
        t.mentions.select("globaleventid").distinct(), "globaleventid", "left_semi"
    )
    eligible = lookup_join(mentioned, imaged_urls(t.gkg), "sourceurl", "left_semi")
    order = [desc("score"), asc("globaleventid")]
    first = settled(top_n(eligible, limit, order))
    by_confidence = [F.desc_nulls_last("confidence")]
    mentions = t.mentions.select("globaleventid", "confidence")
    records = article_records(t.gkg.filter(F.col("sharingimage").isNotNull()))
    rows = expanded(
        first,
        first_children(mentions, first, "globaleventid", by_confidence, limit),
        "globaleventid",
        order,
        by_confidence,
        limit,
        "inner",
    )
    rows = expanded(
        rows,
        first_children(records, first, "sourceurl", record_order(), limit),
        "sourceurl",
        [*order, *by_confidence],
        record_order(),
        limit,
        "inner",
    )
    return rows.select(
        F.col("globaleventid").alias("id"),
        F.col("actor1name").alias("actor1_name"),
        F.col("actor2name").alias("actor2_name"),
        "dateadded",
        "event_date",
        "eventcode",
        "nummentions",
        "avgtone",
        F.col("sourceurl").alias("url"),
        F.col("sourceurl").alias("documentidentifier"),
        "confidence",
        "sourcecommonname",
        "first_theme",
        F.col("sharingimage").alias("image"),
        F.coalesce("page_title", F.lit(DEFAULT_TITLE)).alias("title"),
    )


def event_per_url(t: NewsTables) -> DataFrame:
    """Per URL the most mentioned event that has a mention, with its confidence.

    It covers every URL: restricting it to those of the matching records would take
    a second scan of the records and the same exchange of the events by URL.
    """
    events = _events(t.events).filter(F.col("sourceurl").isNotNull())
    return distinct_on(
        events.join(_highest_confidence(t.mentions), "globaleventid"),
        ["sourceurl"],
        [desc("nummentions"), asc("globaleventid"), F.desc_nulls_last("confidence")],
    )


def filter_news(
    t: NewsTables, theme: str, limit: int = 50, *, literal: bool = False
) -> DataFrame:
    """Most mentioned news with a theme that contains ``theme``, one per title.

    ``%`` and ``_`` in ``theme`` are wildcards unless ``literal`` is set.
    """
    if not theme:
        raise ValueError("theme is required")
    found = (
        contains_ignoring_case(F.col("theme"), theme)
        if literal
        else F.col("theme").ilike(f"%{theme}%")
    )
    return news_of_records(t, t.gkg_themes.filter(found).select("gkgrecordid").distinct(), limit)


def news_of_records(t: NewsTables, ids: DataFrame, limit: int) -> DataFrame:
    """Most mentioned news of some records (distinct ``gkgrecordid``), one per title."""
    records = article_records(lookup_join(t.gkg, ids, "gkgrecordid", "left_semi"))
    joined = lookup_join(records, event_per_url(t), "sourceurl")
    per_title = distinct_on(
        joined, ["page_title"], [desc("nummentions"), asc("globaleventid"), *record_order()]
    )
    order = [desc("nummentions"), asc("globaleventid"), asc("page_title")]
    return to_article(top_n(per_title, limit, order))


def all_articles(t: NewsTables) -> DataFrame:
    """Every event as an article: first record of its URL, strongest confidence."""
    records = distinct_on(article_records(t.gkg), ["sourceurl"], record_order())
    events = _events(t.events).join(strongest_confidence(t.mentions), "globaleventid", "left")
    return to_article(lookup_join(events, records, "sourceurl", "left"))


def _articles_of(t: NewsTables, first: DataFrame, limit: int, order: list[Column]) -> DataFrame:
    """``all_articles`` for a small materialised set of events."""
    confidences = strongest_confidence(
        t.mentions.join(small(first.select("globaleventid"), limit), "globaleventid", "left_semi")
    )
    urls = first.select("sourceurl").distinct()
    records = distinct_on(
        article_records(t.gkg).join(small(urls, limit), "sourceurl", "left_semi"),
        ["sourceurl"],
        record_order(),
    )
    rows = first.join(confidences, "globaleventid", "left").join(records, "sourceurl", "left")
    return to_article(top_n(rows, limit, order))


def recent_news(t: NewsTables, limit: int = 500) -> DataFrame:
    """Newest events first, as articles."""
    order = [desc("dateadded"), asc("globaleventid")]
    return _articles_of(t, settled(top_n(_events(t.events), limit, order)), limit, order)


def latest_news(t: NewsTables, as_of: str, hours: int = 24, limit: int = 20) -> DataFrame:
    """Newest events of the ``hours`` up to ``as_of`` (``yyyy-MM-dd HH:mm:ss``)."""
    end = F.lit(as_of).cast("timestamp_ntz")
    bounds = [end - F.make_dt_interval(hours=F.lit(hours)), end]
    low, high = [F.date_format(b, "yyyyMMddHHmmss").cast("bigint") for b in bounds]
    events = _events(t.events).filter(F.col("dateadded").between(low, high))
    order = [desc("dateadded"), asc("globaleventid")]
    return _articles_of(t, settled(top_n(events, limit, order)), limit, order)


def contains_search(articles: DataFrame, text: str) -> DataFrame:
    """Articles whose title, actors or theme contain ``text``, ignoring case."""
    if not text:
        raise ValueError("search text is required")
    found = F.lit(False)
    for column in ("title", "actor1_name", "actor2_name", "theme"):
        found = found | contains_ignoring_case(F.col(column), text)
    return articles.filter(found)


def source_filter(articles: DataFrame, source: str = "All") -> DataFrame:
    """Articles of a source; 'All' keeps every article."""
    if source == "All":
        return articles
    return articles.filter(contains_ignoring_case(F.col("source"), source))


def without_featured(articles: DataFrame, featured: DataFrame) -> DataFrame:
    """Articles that are not among the featured ones."""
    return articles.join(featured.select("id").distinct(), "id", "left_anti")

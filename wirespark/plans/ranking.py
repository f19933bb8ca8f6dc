"""The ranking of ``top_news`` kept up to date drop by drop.

A drop may bring events, mentions of any event and records of any URL. Only what it can change is
looked at: events it brings, events whose confidence its mentions strengthen, and events whose URL
it gives a first picture.
Of these the stories are ranked anew, and of the URLs on which a story's best event came or went
the best story. A story's best event can only be overtaken, since an event's confidence only grows
in strength, so a story's past winners never come back; a URL's winner can leave for another URL,
so a URL is ranked over the present winners of its stories.

The state is a set of ``KeyedLog`` below one folder; a drop reads the buckets and ranges of its
own keys. The rows of a drop are counted from 0, and a drop that is run again writes the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wirespark.operators.joins import lookup_join
from wirespark.operators.keyed import distinct_on, small, top_n, top_n_merged
from wirespark.plans.news import (
    EVENT_COLUMNS,
    STORY,
    article_records,
    imaged_urls,
    rankable_events,
    record_order,
    strength_order,
    to_article,
    top_order,
)
from wirespark.schemas import NewsTables, table_schema
from wirespark.session import written
from wirespark.stores.keyed_log import BUCKETS, KeyedLog

def _event_schema() -> T.StructType:
    kept = [f for f in table_schema("events").fields if f.name in EVENT_COLUMNS]
    return T.StructType([*kept, T.StructField("event_date", T.DateType())])


def _winner_schema() -> T.StructType:
    story = [T.StructField(name, T.StringType()) for name in ("story", "actor")]
    confidence = T.StructField("confidence", T.DoubleType())
    return T.StructType([*story, *_event_schema().fields, confidence])


def _bounds(mentions: DataFrame) -> DataFrame:
    return mentions.groupBy("globaleventid").agg(
        F.max("high").alias("high"), F.min("low").alias("low")
    )


def _strongest(high: str, low: str) -> Column:
    """The bound of greater magnitude (positive before negative)."""
    return F.when(F.col(high) >= -F.col(low), F.col(high)).otherwise(F.col(low))


def _best_of_stories(rows: DataFrame) -> DataFrame:
    return distinct_on(rows, ["story"], strength_order())


def _latest_of_urls(rows: DataFrame) -> DataFrame:
    """The winner of the last drop that ranked the URL."""
    return distinct_on(rows, ["sourceurl"], [F.desc("drop")])


class Ranking:
    """The maintained ranking below ``path``."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        bounds = T.StructType.fromDDL("globaleventid string, high double, low double")
        url = T.StructType.fromDDL("sourceurl string")
        linked = T.StructType.fromDDL("sourceurl string, globaleventid string")

        def log(name, key, schema, merge=None):
            return KeyedLog(spark, f"{path}/{name}", key, schema, merge, buckets)

        event, winner = _event_schema(), _winner_schema()
        url_winner = T.StructType([*winner.fields, T.StructField("drop", T.LongType())])
        self.event, self.winner, self.url_winner = event.names, winner.names, url_winner.names
        self.spark = spark
        self.events = log("events", "globaleventid", event)
        self.by_url = log("events_by_url", "sourceurl", linked)
        self.bounds = log("bounds", "globaleventid", bounds, _bounds)
        self.pictured = log("pictured", "sourceurl", url)
        self.stories = log("stories", "story", winner, _best_of_stories)
        self.story_urls = log("stories_by_url", "sourceurl", winner)
        self.urls = log("urls", "sourceurl", url_winner, _latest_of_urls)

    def update(self, drop: int, events: DataFrame, mentions: DataFrame, gkg: DataFrame) -> None:
        """Take in the rows of drop number ``drop``; earlier drops must have been taken in.

        Of an event that comes again the first delivery counts.
        """
        first = [F.asc_nulls_last(c) for c in ("dateadded", *events.columns)]
        once = distinct_on(events.filter("globaleventid IS NOT NULL"), ["globaleventid"], first)
        given = written(rankable_events(once).select(*self.event), "events")
        known = self.events.among(given, drop).select("globaleventid")  # each is there once
        new = self.events.add(lookup_join(given, known, "globaleventid", "left_anti"), drop)
        self.by_url.add(new.select("sourceurl", "globaleventid"), drop)

        said = mentions.filter("confidence IS NOT NULL AND globaleventid IS NOT NULL")
        said = said.select(
            "globaleventid", F.col("confidence").alias("high"), F.col("confidence").alias("low")
        )
        grown = self.bounds.add(self._grown(written(_bounds(said), "bounds"), drop), drop)

        urls = written(imaged_urls(gkg).filter("sourceurl IS NOT NULL"), "urls")
        before = self.pictured.among(urls, drop)
        pictured = self.pictured.add(lookup_join(urls, before, "sourceurl", "left_anti"), drop)
        linked = lookup_join(
            self.by_url.among(pictured, drop), pictured, "sourceurl", "left_semi"
        )

        ids = new.select("globaleventid").union(grown.select("globaleventid"))
        touched = written(ids.union(linked.select("globaleventid")).distinct(), "touched")
        self._rank(drop, self._scored(touched, drop + 1))

    def _grown(self, bounds: DataFrame, drop: int) -> DataFrame:
        """Those of a drop's bounds that change the strongest confidence of their event.

        Of two parts of an event's mentions, the stronger of their strongest is that of both, so
        bounds that change nothing now never will.
        """
        ids = bounds.select("globaleventid")
        earlier = self.bounds.among(bounds, drop).join(ids, "globaleventid", "left_semi")
        was = _bounds(earlier).withColumnsRenamed({"high": "was_high", "low": "was_low"})
        both = bounds.join(was, "globaleventid", "left")
        both = both.withColumn("high", F.greatest("high", "was_high"))
        both = both.withColumn("low", F.least("low", "was_low"))
        same = _strongest("high", "low").eqNullSafe(_strongest("was_high", "was_low"))
        return both.filter(~same).select("globaleventid", "high", "low")

    def _scored(self, ids: DataFrame, drop: int) -> DataFrame:
        """Events among ``ids`` that can be ranked, with their story and strongest confidence."""
        # An event has one row, and bounds in few drops: no key is hot, and rows dealt by id once
        # serve all of these joins and the grouping.
        events = self.events.among(ids, drop).join(ids, "globaleventid", "left_semi")
        bounds = _bounds(self.bounds.among(ids, drop).join(ids, "globaleventid", "left_semi"))
        confidences = bounds.select("globaleventid", _strongest("high", "low").alias("confidence"))
        rated = written(events.join(confidences, "globaleventid"), "rated")
        seen = lookup_join(rated, self.pictured.among(rated, drop), "sourceurl", "left_semi")
        named = seen.withColumn("actor", F.coalesce("actor1name", "actor2name"))
        # Minus zero is zero, as it is to a grouping.
        parts = [(F.col(c) + 0.0) if c == "avgtone" else F.col(c) for c in STORY]
        story = F.to_json(F.struct(*[p.alias(c) for p, c in zip(parts, STORY, strict=True)]))
        return named.withColumn("story", story).select(*self.winner)

    def _rank(self, drop: int, scored: DataFrame) -> None:
        best = written(_best_of_stories(scored), "best")
        stories = best.select("story")
        past = self.stories.among(best, drop).join(stories, "story", "left_semi")
        # A story has a row of this drop and at most one of each earlier one. Rows alike in the
        # whole order are of one event with one confidence, so they are the same.
        rows = best.withColumn("new", F.lit(1)).unionByName(past.withColumn("new", F.lit(0)))
        by_strength = Window.partitionBy("story").orderBy(*strength_order(), F.asc("new"))
        placed = rows.withColumn("place", F.row_number().over(by_strength))
        placed = placed.withColumn("replaced", F.lead("sourceurl").over(by_strength))
        first = placed.filter((F.col("place") == 1) & (F.col("new") == 1))
        changed = written(first.select(*self.winner, "replaced"), "changed")
        self.stories.add(changed, drop)
        self.story_urls.add(changed, drop)

        replaced = changed.select(F.col("replaced").alias("sourceurl"))
        urls = changed.select("sourceurl").union(replaced.filter("sourceurl IS NOT NULL"))
        urls = written(urls.distinct(), "ranked")
        able = lookup_join(self.story_urls.among(urls, drop + 1), urls, "sourceurl", "left_semi")
        able = written(able, "able")
        stories = able.select("story")
        now = _best_of_stories(
            self.stories.among(able, drop + 1).join(stories, "story", "left_semi")
        )
        # Past winners of a story are on other rows than its present one: an event's row is told
        # by its confidence.
        row = ["story", "globaleventid", "confidence"]
        current = able.join(now.select(*row), row, "left_semi")
        winners = distinct_on(current, ["sourceurl"], strength_order())
        ranked = urls.join(winners, "sourceurl", "left").withColumn("drop", F.lit(drop).cast("long"))
        self.urls.add(ranked.select(*self.url_winner), drop)

    def top_news(self, drops: int, gkg: DataFrame, limit: int = 5000) -> DataFrame:
        """``news.top_news`` over all rows of the first ``drops`` drops.

        Reads one row per URL, and of the records only those of the winners.
        """
        current = _latest_of_urls(self.urls.before(drops)).filter("globaleventid IS NOT NULL")
        winners = top_n_merged(current.drop("story", "drop"), limit, top_order())
        records = article_records(gkg.filter(F.col("sharingimage").isNotNull()))
        detailed = distinct_on(
            records.join(small(winners, limit), "sourceurl"), ["sourceurl"], record_order()
        )
        return to_article(top_n(detailed, limit, top_order()))

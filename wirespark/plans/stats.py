"""Facets, counts and table checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirespark.functions.cards import theme_label
from wirespark.functions.dates import days_before
from wirespark.operators.joins import pair_count
from wirespark.operators.keyed import facet, top_n
from wirespark.schemas import NewsTables


def _rows() -> Column:
    return F.count(F.lit(1))


def facet_themes(t: NewsTables, limit: int = 100) -> DataFrame:
    return facet(t.gkg_themes, "theme", limit)


def facet_sources(t: NewsTables, limit: int = 20) -> DataFrame:
    return facet(t.gkg, "sourcecommonname", limit, "source")


def theme_menu(t: NewsTables, limit: int = 20) -> DataFrame:
    """Most frequent themes with their display labels."""
    return facet_themes(t, limit).withColumn("label", theme_label(F.col("theme")))


def _metrics(df: DataFrame, **values: Column) -> DataFrame:
    """Aggregates of one frame as ``(metric, value)`` rows, from one pass over it."""
    one = df.agg(*[value.cast("bigint").alias(name) for name, value in values.items()])
    return one.unpivot([], list(values), "metric", "value")


def _stacked(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def stats(t: NewsTables, as_of: str, *, approximate: bool = False) -> DataFrame:
    """Five named counts; recent means the seven days before ``as_of`` (yyyy-MM-dd)."""
    week_ago = days_before(F.lit(as_of).cast("date"), 7)
    distinct = F.approx_count_distinct("theme") if approximate else F.countDistinct("theme")
    return _stacked(
        _metrics(
            t.events, total_events=_rows(), recent_events=F.count_if(F.col("sqldate") >= week_ago)
        ),
        _metrics(t.mentions, total_mentions=_rows()),
        _metrics(t.gkg, total_gkg=_rows()),
        _metrics(t.gkg_themes, total_themes=distinct),
    )


def table_profile(t: NewsTables) -> DataFrame:
    """Row counts and the sizes of the two id overlaps."""
    same_ids = pair_count(t.events, t.gkg, "globaleventid", "gkgrecordid")
    mentioned = pair_count(t.events, t.mentions, "globaleventid", "globaleventid")
    return _stacked(
        _metrics(t.events, events_count=_rows()),
        _metrics(t.mentions, mentions_count=_rows()),
        _metrics(t.gkg, gkg_count=_rows()),
        _metrics(t.gkg_themes, themes_count=_rows()),
        _metrics(same_ids, common_event_gkg_ids=F.sum("count")),
        _metrics(mentioned, common_event_mention_ids=F.sum("count")),
    )


def total(results: DataFrame) -> DataFrame:
    """Row count of a result, as one row ``(total)``."""
    return results.agg(_rows().alias("total"))


def sample(df: DataFrame, columns: list[str], n: int) -> DataFrame:
    """First ``n`` rows of a projection in the order of its columns."""
    return top_n(df.select(*columns), n, [F.asc_nulls_last(c) for c in columns])


def sample_events(t: NewsTables, n: int = 10) -> DataFrame:
    return sample(t.events, ["globaleventid", "sqldate", "actor1name", "nummentions"], n)


def table_samples(t: NewsTables, n: int = 5) -> dict[str, DataFrame]:
    """A few rows of each base table."""
    events = ["globaleventid", "sqldate", "actor1name", "actor2name", "nummentions"]
    return {
        "events": sample(t.events, events, n),
        "mentions": sample(t.mentions, ["globaleventid", "mentionssource", "confidence"], n),
        "gkg": sample(t.gkg, ["gkgrecordid", "sourcecommonname", "sharingimage"], n),
    }

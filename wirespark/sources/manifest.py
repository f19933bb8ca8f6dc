"""Which feed files belong to a time range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wirespark.functions.dates import round_quarter_hour, stamp

# File ending of each feed.
FEED_FILES = {
    "export": "export.CSV.zip",
    "mentions": "mentions.CSV.zip",
    "gkg": "gkg.csv.zip",
}
DEFAULT_HOURS = 3


def quarter_hour_range(column: Column, as_of: Column) -> tuple[Column, Column]:
    """Rounded start and the default end three hours later; both NULL if not in the past."""
    start = round_quarter_hour(column, as_of)
    return start, start + F.make_dt_interval(hours=F.lit(DEFAULT_HOURS))


def parse_minute(text: Column) -> Column:
    """Timestamp of ``yyyy-MM-dd HH:mm``; NULL for other text."""
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm")).cast("timestamp_ntz")


def intervals(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """Quarter-hour names ``(interval)`` of each range, both ends included."""
    steps = F.sequence(
        F.col(start).cast("timestamp_ntz"),
        F.col(end).cast("timestamp_ntz"),
        F.make_dt_interval(mins=F.lit(15)),
    )
    valid = ranges.filter(F.col(start) <= F.col(end))
    return valid.select(F.explode(steps).alias("_step")).select(
        stamp(F.col("_step")).alias("interval")
    )


def feed_manifest(steps: DataFrame, base_url: str, base_dir: str) -> DataFrame:
    """``(interval, feed, url, path)``, one row per interval and feed."""
    files = F.array(
        *[
            F.struct(F.lit(feed).alias("feed"), F.lit(ending).alias("ending"))
            for feed, ending in FEED_FILES.items()
        ]
    )
    rows = steps.select("interval", F.inline(files))
    name = F.concat_ws(".", "interval", "ending")
    return rows.select(
        "interval",
        "feed",
        F.concat(F.lit(base_url.rstrip("/") + "/"), name).alias("url"),
        F.concat(F.lit(base_dir.rstrip("/") + "/"), F.col("feed"), F.lit("/"), name).alias("path"),
    )

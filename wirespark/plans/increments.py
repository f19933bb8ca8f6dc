"""The transform job for feeds that keep coming: a run writes the rows of new files only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirespark.operators.joins import lookup_join
from wirespark.plans.etl import child_table, unique_events
from wirespark.schemas import BASE_TABLES, CHILD_TABLES, TABLE_NAMES, NewsTables, table_schema
from wirespark.session import written
from wirespark.sources import feeds
from wirespark.stores.keyed_log import KeyedLog
from wirespark.stores.snapshots import Snapshots

#: Parts of a table from which ``compact`` pays off: readers list and open all of them.
MANY_PARTS = 64


def landed(spark: SparkSession, extract_dir: str) -> DataFrame:
    """``(name, path)`` of the landed files of each feed; only their metadata is read."""
    found = None
    for feed in BASE_TABLES.values():
        files = spark.read.format("binaryFile").option("pathGlobFilter", feeds.CSV_FILES)
        files = files.option("recursiveFileLookup", "true").load(f"{extract_dir}/{feed}")
        listed = files.select(F.lit(feed).alias("name"), "path")
        found = listed if found is None else found.unionByName(listed)
    return found


def transform_new(spark: SparkSession, extract_dir: str, base: str) -> int:
    """Clean the landed files that no run has taken yet and add their rows to the tables.

    A file is taken once, by its path. An event that was delivered before is not added again;
    its id is looked up among those of earlier runs (``KeyedLog``). Child tables are exploded
    from the new records. Returns the version that now holds all files; without new files that
    is the last one, and nothing is written.
    """
    snapshots = Snapshots(spark, base)
    version = snapshots.last() + 1
    new = snapshots.not_taken(landed(spark, extract_dir)).collect()
    if not new:
        return version - 1
    by_feed: dict[str, list[str]] = {}
    for row in new:
        by_feed.setdefault(row["name"], []).append(row["path"])
    tables = []
    for table, feed in BASE_TABLES.items():
        if feed in by_feed:
            rows = feeds.read_feed(spark, sorted(by_feed[feed]), feed)
            if table == "events":
                rows = _new_events(spark, base, rows, version)
            rows.write.mode("overwrite").parquet(snapshots.part(table, version))
            tables.append(table)
    none = spark.createDataFrame([], table_schema("events"))
    events = _part(snapshots, "events", version) if "events" in tables else none
    _events_of(spark, base).add(events, version)
    if "gkg" in tables:
        records = _part(snapshots, "gkg", version)
        for table in CHILD_TABLES:
            part = snapshots.part(table, version)
            child_table(records, table).write.mode("overwrite").parquet(part)
            tables.append(table)
    files = spark.createDataFrame([(r["name"], r["path"]) for r in new], "name string, path string")
    snapshots.commit(version, tables, files)
    return version


def _events_of(spark: SparkSession, base: str) -> KeyedLog:
    schema = table_schema("events")
    return KeyedLog(spark, f"{base}/event_ids", "globaleventid", schema[:1])


def _new_events(spark: SparkSession, base: str, rows: DataFrame, version: int) -> DataFrame:
    if not version:
        return unique_events(rows)
    once = written(unique_events(rows), "events")
    known = _events_of(spark, base).among(once, version)  # each id is there once
    return lookup_join(once, known, "globaleventid", "left_anti")


def _part(snapshots: Snapshots, table: str, version: int) -> DataFrame:
    reader = snapshots.spark.read.schema(table_schema(table))
    return reader.parquet(snapshots.part(table, version))


def read_version(spark: SparkSession, base: str, version: int | None = None) -> NewsTables:
    """All relations as of a version, the last one unless given."""
    snapshots = Snapshots(spark, base)
    version = snapshots.last() if version is None else version
    return NewsTables(
        **{table: snapshots.read(table, table_schema(table), version) for table in TABLE_NAMES}
    )


def compact(spark: SparkSession, base: str, many: int = MANY_PARTS) -> int:
    """Write the parts of tables with at least ``many`` of them as one, as a new version."""
    snapshots = Snapshots(spark, base)
    last = snapshots.last()
    parts = snapshots.parts(last)
    if max(map(len, parts.values()), default=0) < many:
        return last
    version = last + 1
    for table in parts:
        rows = snapshots.read(table, table_schema(table), last)
        rows.hint("rebalance").write.mode("overwrite").parquet(snapshots.part(table, version))
    _events_of(spark, base).add(spark.createDataFrame([], table_schema("events")), version)
    none = spark.createDataFrame([], "name string, path string")
    snapshots.commit(version, list(parts), none, replace=True)
    return version

"""Incremental ingest of feed drops with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from wirespark.operators.joins import lookup_join
from wirespark.operators.keyed import distinct_on
from wirespark.schemas import raw_schema
from wirespark.session import written
from wirespark.sources.feeds import CSV_FILES, CSV_OPTIONS, typed
from wirespark.stores.keyed_log import KeyedLog

BATCH = "batch"
KEYS = {"export": "globaleventid", "gkg": "gkgrecordid"}


def stream_feed(
    spark: SparkSession, path: str, feed: str, *, files_per_batch: int = 1000
) -> DataFrame:
    """Typed rows of the feed files that arrive below ``path``."""
    reader = spark.readStream.schema(raw_schema(feed)).options(**CSV_OPTIONS)
    reader = reader.option("pathGlobFilter", CSV_FILES).option("recursiveFileLookup", "true")
    return typed(reader.option("maxFilesPerTrigger", files_per_batch).csv(path), feed)


def first_deliveries(rows: DataFrame, feed: str) -> DataFrame:
    """First delivery of every id within ``rows``, in column order.

    Rows without an id are no repeats of one another, and mentions have no key; both are
    passed on.
    """
    if feed not in KEYS:
        return rows
    key = KEYS[feed]
    # Rows without an id get a key of their own.
    alone = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    first = [F.asc_nulls_last(c) for c in rows.columns]
    return distinct_on(rows.withColumn("_alone", alone), [key, "_alone"], first).drop("_alone")


def without_repeats(rows: DataFrame, stored: DataFrame | None, feed: str) -> DataFrame:
    """First delivery of every id that is not stored yet, however old its stamp is."""
    fresh = first_deliveries(rows, feed)
    return fresh if stored is None or feed not in KEYS else _unseen(fresh, stored, KEYS[feed])


def _unseen(fresh: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    return lookup_join(fresh, stored.select(key).distinct(), key, "left_anti")


def ingest(
    spark: SparkSession,
    drops: str,
    out: str,
    checkpoint: str,
    feed: str = "export",
    *,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Process all drops not seen yet and add their new records to the Parquet table ``out``.

    Every batch has a folder of its own and is compared with the ids of earlier batches
    only, kept in ``<out>_ids`` (see ``stores.keyed_log``): it reads those that its own ids can be
    among and none of the stored rows. A batch that is run again after a failure overwrites its
    folders, so nothing is lost or stored twice. No late row is dropped, however old its stamp is.
    ``out`` and its ids belong to ``checkpoint``: a new checkpoint numbers its batches anew and
    needs a new table.
    """

    def store(rows: DataFrame, batch: int) -> None:
        folder = f"{out}/{BATCH}={batch}"
        if feed not in KEYS:
            rows.write.mode("overwrite").parquet(folder)
            return
        key = KEYS[feed]
        seen = KeyedLog(rows.sparkSession, ids_of(out), key, rows.select(key).schema)
        fresh = written(first_deliveries(rows, feed), "batch")
        new = _unseen(fresh, seen.among(fresh, batch), key) if batch else fresh
        new.select(*rows.columns).write.mode("overwrite").parquet(folder)
        seen.add(rows.sparkSession.read.schema(rows.schema).parquet(folder), batch)

    return (
        stream_feed(spark, drops, feed, files_per_batch=files_per_batch)
        .writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ids_of(out: str) -> str:
    """Folder of the ids of a stored table."""
    return f"{out.rstrip('/')}_ids"

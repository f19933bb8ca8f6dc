"""Raw feed files: tab-separated, no header, quoted fields."""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wirespark.schemas import FEED_COLUMNS, RAW_WIDTH, raw_schema

CSV_OPTIONS = {"sep": "\t", "header": "false", "multiLine": "true", "quote": '"', "escape": '"'}
CSV_FILES = "*.[cC][sS][vV]"
CORRUPT = "_corrupt"


def feed_of(path: str) -> str:
    """Feed a file belongs to, by its name."""
    name = os.path.basename(path.rstrip("/")).lower()
    for feed in FEED_COLUMNS:
        if feed in name:
            return feed
    raise ValueError(f"unknown feed: {name}")


def _check(feed: str) -> None:
    if feed not in FEED_COLUMNS:
        raise ValueError(f"unknown feed: {feed}")


def read_raw(
    spark: SparkSession, paths: str | list[str], feed: str, files: str = CSV_FILES
) -> DataFrame:
    """All raw positions as text and the name of the file, ``_file``.

    ``paths`` are files or folders; a folder is one read of its ``.csv`` files in
    either case, or of other ``files``. Short records are filled up with NULL.
    """
    _check(feed)
    reader = spark.read.schema(raw_schema(feed)).options(**CSV_OPTIONS)
    files = reader.option("pathGlobFilter", files).csv(paths)
    return files.select("*", F.col("_metadata.file_name").alias("_file"))


def rejected(spark: SparkSession, paths: str | list[str], feed: str) -> DataFrame:
    """Records with a wrong number of fields: ``(_file, record_key, _corrupt)``.

    Fields are only counted when every column is parsed, hence without pruning.
    """
    _check(feed)
    schema = T.StructType([*raw_schema(feed), T.StructField(CORRUPT, T.StringType())])
    reader = spark.read.schema(schema).options(**CSV_OPTIONS, columnPruning="false")
    reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    files = reader.option("pathGlobFilter", CSV_FILES).csv(paths)
    return files.filter(F.col(CORRUPT).isNotNull()).select(
        F.col("_metadata.file_name").alias("_file"), F.col("_c0").alias("record_key"), CORRUPT
    )


def typed(raw: DataFrame, feed: str, keep: Iterable[str] = ()) -> DataFrame:
    """Feed columns by position, cast; a value that does not parse becomes NULL."""
    _check(feed)
    columns = [
        F.col(f"_c{position}").try_cast(dtype).alias(name)
        for position, name, dtype in FEED_COLUMNS[feed]
    ]
    return raw.select(*columns, *keep)


def read_feed(spark: SparkSession, paths: str | list[str], feed: str | None = None) -> DataFrame:
    """Typed rows of a feed; without ``feed`` the file name decides which."""
    if feed is None:
        feed = feed_of(paths if isinstance(paths, str) else paths[0])
    return typed(read_raw(spark, paths, feed), feed)


def raw_rows(df: DataFrame, feed: str) -> DataFrame:
    """A typed feed laid out at its raw positions, for writing feed files."""
    _check(feed)
    at = {position: name for position, name, _ in FEED_COLUMNS[feed]}
    return df.select(
        *[
            (F.col(at[i]).cast("string") if i in at else F.lit(None).cast("string")).alias(f"_c{i}")
            for i in range(RAW_WIDTH[feed])
        ]
    )


def write_feed(df: DataFrame, path: str, feed: str) -> None:
    """Write feed files (several part files, each readable by ``read_feed``).

    The format does not tell an empty text from a missing one: both read as NULL.
    """
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "multiLine"}
    raw_rows(df, feed).write.mode("overwrite").options(**options).csv(path)

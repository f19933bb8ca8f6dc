"""Zipped feed files: unpacked by tasks, then read like plain ones."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirespark.schemas import FEED_COLUMNS
from wirespark.session import new_folder
from wirespark.sources import feeds

BATCH_LINES = 5000
MEMBER = "member"


def unpack(spark: SparkSession, path: str, out: str) -> None:
    """Write the lines of every ``.csv`` member of every ``.zip`` below ``path`` as text files.

    Archives are spread over tasks by Spark; a task streams one member at a time and hands over
    its lines as they are. The lines of a member stay together and in order, in the folder
    ``out/member=<name>``.
    """

    def lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for archive, content in zip(frame["path"], frame["content"], strict=True):
                yield from _member_lines(archive, content)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[zZ][iI][pP]").load(path)
    schema = f"{MEMBER} string, archive string, line bigint, value string"
    found = files.select("path", "content").mapInPandas(lines, schema)
    ordered = found.sortWithinPartitions(MEMBER, "archive", "line")
    ordered.select(MEMBER, "value").write.partitionBy(MEMBER).text(out)


def _member_lines(path: str, content: bytes) -> Iterator[pd.DataFrame]:
    with zipfile.ZipFile(io.BytesIO(content)) as archive:
        for member in archive.namelist():
            if not member.lower().endswith(".csv"):
                continue
            with archive.open(member) as stream:
                text = io.TextIOWrapper(stream, encoding="utf-8", errors="replace", newline="\n")
                start = 0
                while batch := [line.removesuffix("\n") for line in islice(text, BATCH_LINES)]:
                    rows = {"line": range(start, start + len(batch)), "value": batch}
                    yield pd.DataFrame(rows).assign(archive=path, member=member)[
                        [MEMBER, "archive", "line", "value"]
                    ]
                    start += len(batch)


def read_archives(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """Raw positions of every record of every ``.zip`` below ``path``, plus ``_file``.

    The archives are unpacked to the shared folder and parsed by ``feeds.read_raw``; the result
    goes through ``feeds.typed`` like a plain file. ``_file`` is the member's name.
    """
    if feed not in FEED_COLUMNS:
        raise ValueError(f"unknown feed: {feed}")
    out = new_folder(spark, "unpacked")
    unpack(spark, path, out)
    raw = feeds.read_raw(spark, out, feed, files="*.txt")
    if MEMBER not in raw.columns:  # no member at all
        return raw
    return raw.withColumn("_file", F.col(MEMBER).cast("string")).drop(MEMBER)


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """``(folder, name, type, bytes)`` of the files one folder below ``path``."""
    # Only file metadata is selected, so no content is read.
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    parts = F.split("path", "/")
    name = F.element_at(parts, -1)
    return files.select(
        F.element_at(parts, -2).alias("folder"),
        name.alias("name"),
        F.when(F.lower(name).endswith(".zip"), F.lit("ZIP")).otherwise(F.lit("CSV")).alias("type"),
        F.col("length").alias("bytes"),
    )


def landed_summary(files: DataFrame) -> DataFrame:
    """File count and size per folder and type."""
    return files.groupBy("folder", "type").agg(
        F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes")
    )

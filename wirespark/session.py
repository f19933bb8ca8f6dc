"""Shared folder and checkpoints; the caller owns the session and its sizing."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
#: Bytes of a row group of intermediate results.
WRITTEN_BLOCK = 8 << 20


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: the session's checkpoint setting.

    Where it is unset (a local test session) a new local folder is set; a cluster
    session without the setting is refused.
    """
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_CONF} must name a shared folder")
    folder = tempfile.mkdtemp(prefix="run-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a not yet used folder below the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder as Parquet and read it back.

    Like ``settled``, but readers take the columns they need and their filters reach the files.
    Row groups are small, so that several tasks can read a file that one task has written.
    """
    path = new_folder(df.sparkSession, name)
    df.write.option("parquet.block.size", WRITTEN_BLOCK).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def kept_while(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``written``, compressed well, for as long as the ``with`` block runs.

    Its files are then overwritten by an empty table, and the shuffle files behind it are given up,
    so steps that follow each other need the disk of one at a time. Nothing lazy that reads the
    frame may leave the block.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    writer = df.write.option("parquet.block.size", WRITTEN_BLOCK).option("compression", "zstd")
    writer.parquet(path)
    _give_up_shuffles(spark)
    yield spark.read.schema(df.schema).parquet(path)
    spark.createDataFrame([], df.schema).write.mode("overwrite").parquet(path)
    _give_up_shuffles(spark)


def _give_up_shuffles(spark: SparkSession) -> None:
    """Spark removes shuffle files once the driver's JVM finds their plans unreachable; without
    being asked, a driver with memory to spare may look for them long after."""
    spark.sparkContext._jvm.System.gc()


def settled(df: DataFrame) -> DataFrame:
    """Materialise a frame that later steps use more than once."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()

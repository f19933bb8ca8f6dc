"""Rows by key that arrive batch by batch, of which a batch reads its own share only.

Every batch writes its rows to a folder of its own, dealt into buckets by a hash of the key and
sorted within them. A later batch reads the buckets that its own keys fall into, and of these the
row groups whose range of keys, and for few keys Bloom filter, lets one of them be in. Full tiers
are merged: the folders of ``TIER`` batches become one, those of ``TIER`` such folders again one,
so a batch looks into few folders however many there were before it. Which folders hold what
follows from the batch number alone, and a batch that is run again writes the same ones: nothing
is deleted, nothing has to be repaired after a failure, and every row is stored once a tier.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64
TIER = 16
#: Up to this many keys are named in a filter, which Bloom filters can answer.
NAMED_KEYS = 200
BUCKET = "bucket"


def folders(batch: int) -> list[str]:
    """Folders that together hold the rows of all batches before ``batch``."""
    found, end, level = [], batch, 0
    while end:
        size = TIER**level
        found += [f"level={level}/last={(end - i) * size - 1}" for i in range(end % TIER)]
        end, level = end // TIER, level + 1
    return found


def one_of(column: Column, values: list) -> Column:
    """Whether a column is one of the values, in tests that reach a file's statistics and Bloom
    filters value by value (of a longer list only the least and the largest would)."""
    tens = [column.isin(values[i : i + 10]) for i in range(0, len(values), 10)]
    return reduce(or_, tens, F.lit(False))


def bloom_filter(column: str) -> dict[str, str]:
    """Write options for a Bloom filter on a column, as large as its values ask for."""
    return {
        f"parquet.bloom.filter.enabled#{column}": "true",
        "parquet.bloom.filter.adaptive.enabled": "true",
    }


class KeyedLog:
    """Rows of one schema by the column ``key``.

    ``merge`` reduces the rows of a key where tiers are merged; what it gives for merged and
    for single rows must lead a reader to the same end.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        key: str,
        schema: T.StructType,
        merge: Callable[[DataFrame], DataFrame] | None = None,
        buckets: int = BUCKETS,
    ):
        self.spark, self.path, self.key = spark, path, key
        self.schema, self.merge, self.buckets = schema, merge, buckets

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def _read(self, names: list[str]) -> DataFrame:
        if not names:  # known to be empty when planned, unlike a frame made of Python rows
            columns = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema]
            return self.spark.range(1).select(*columns, F.lit(0).alias(BUCKET)).filter(F.lit(False))
        schema = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        reader = self.spark.read.schema(schema)
        return reduce(DataFrame.unionByName, [reader.parquet(f"{self.path}/{n}") for n in names])

    def before(self, batch: int) -> DataFrame:
        """All rows of earlier batches."""
        return self._read(folders(batch)).drop(BUCKET)

    def among(self, keys: DataFrame, batch: int) -> DataFrame:
        """Rows of earlier batches whose key can be one of ``keys`` (a frame with the key column).

        The buckets of the keys (at most as many as there are), the least and the largest key
        and, if they are few, the keys themselves make the filter of the scan. Other keys of
        these buckets can be among the rows, so a join on the key has to follow.
        """
        if not batch:
            return self._read([]).drop(BUCKET)
        key = F.col(self.key)
        given = keys.select(self.key, self._bucket().alias(BUCKET)).filter(key.isNotNull())
        # One pass whose tasks send a row each; only keys that may be few are told apart exactly.
        met = given.agg(
            F.approx_count_distinct(key).alias("keys"),
            F.min(key).alias("low"),
            F.max(key).alias("high"),
            F.collect_set(BUCKET).alias("in"),
        ).first()
        if not met["in"]:
            return self._read([]).drop(BUCKET)
        inside = F.col(BUCKET).isin(sorted(met["in"]))
        stored = self._read(folders(batch)).filter(inside)
        if met["keys"] <= 2 * NAMED_KEYS:
            few = given.select(self.key).distinct().limit(NAMED_KEYS + 1).collect()
            if len(few) <= NAMED_KEYS:
                return stored.filter(one_of(key, [r[self.key] for r in few])).drop(BUCKET)
        return stored.filter(key.between(met["low"], met["high"])).drop(BUCKET)

    def add(self, rows: DataFrame, batch: int) -> DataFrame:
        """Store the rows of a batch (those with a key) and merge the tiers that it fills.

        Returns the rows as stored, so a caller that goes on with them need not write them again.
        """
        given = rows.select(*self.schema.names).filter(F.col(self.key).isNotNull())
        self._write(given, f"level=0/last={batch}")
        level = 1
        while (batch + 1) % TIER**level == 0:
            size = TIER ** (level - 1)
            parts = [f"level={level - 1}/last={batch - i * size}" for i in range(TIER)]
            merged = self._read(parts).drop(BUCKET)
            self._write(self.merge(merged) if self.merge else merged, f"level={level}/last={batch}")
            level += 1
        return self._read([f"level=0/last={batch}"]).drop(BUCKET)

    def _write(self, rows: DataFrame, name: str) -> None:
        dealt = rows.withColumn(BUCKET, self._bucket()).hint("rebalance", BUCKET)
        writer = dealt.sortWithinPartitions(BUCKET, self.key).write.mode("overwrite")
        writer.options(**bloom_filter(self.key)).partitionBy(BUCKET).parquet(f"{self.path}/{name}")

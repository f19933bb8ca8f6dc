"""Versions of tables that grow part by part, and the files they were made of.

A version adds a part folder to tables and becomes visible when its manifest, a single file, is
there; that file names all parts of all tables and the files taken in by this version. So a reader
sees the last whole version, a failed run leaves parts that no manifest names, and the next run
writes these anew. One writer at a time.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MANIFEST = "version bigint, kind string, name string, path string"
PART, FILE = "part", "file"


class Snapshots:
    """The versions of the tables below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _manifests(self) -> DataFrame:
        try:
            return self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifests")
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], _MANIFEST)
            raise

    def last(self) -> int:
        """Number of the last version; -1 before the first."""
        last = self._manifests().agg(F.max("version")).first()[0]
        return -1 if last is None else last

    def parts(self, version: int) -> dict[str, list[str]]:
        """Folders of each table in a version."""
        rows = self._manifests().filter((F.col("version") == version) & (F.col("kind") == PART))
        found: dict[str, list[str]] = {}
        for row in rows.orderBy("name", "path").collect():
            found.setdefault(row["name"], []).append(f"{self.path}/{row['path']}")
        return found

    def not_taken(self, files: DataFrame) -> DataFrame:
        """Those of ``files`` (name, path) that no version has taken in."""
        taken = self._manifests().filter(F.col("kind") == FILE).select("path").distinct()
        return files.join(taken, "path", "left_anti")

    def part(self, name: str, version: int) -> str:
        """Folder of a table's part that belongs to a version."""
        return f"{self.path}/{self._part(name, version)}"

    def _part(self, name: str, version: int) -> str:
        return f"tables/{name}/version={version:09d}"

    def read(self, name: str, schema, version: int | None = None) -> DataFrame:
        """A table as of a version, the last one unless given."""
        version = self.last() if version is None else version
        parts = self.parts(version).get(name, [])
        if not parts:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*parts)

    def commit(
        self, version: int, tables: list[str], files: DataFrame, *, replace: bool = False
    ) -> None:
        """Make a version visible: a part for each of ``tables``, ``files`` (name, path) taken in.

        Parts of the version before stay, unless ``replace`` is set.
        """
        if version != self.last() + 1:
            raise ValueError(f"version {version} does not follow {self.last()}")
        rows = [(name, self._part(name, version)) for name in tables]
        if not replace:
            cut = len(self.path) + 1
            before = self.parts(version - 1).items()
            rows += [(name, path[cut:]) for name, paths in before for path in paths]
        parts = self.spark.createDataFrame(rows, "name string, path string")
        named = parts.withColumn("kind", F.lit(PART)).unionByName(
            files.select("name", "path", F.lit(FILE).alias("kind"))
        )
        manifest = named.withColumn("version", F.lit(version).cast("bigint"))
        manifest = manifest.select("version", "kind", "name", "path").coalesce(1)
        manifest.write.mode("append").parquet(f"{self.path}/manifests")

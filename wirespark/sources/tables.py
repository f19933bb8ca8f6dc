"""Cleaned tables: files, catalog tables, JDBC tables and SQL with arguments."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from wirespark.schemas import TABLE_NAMES, NewsTables, table_schema


def read_clean(spark: SparkSession, base: str, table: str, fmt: str = "parquet") -> DataFrame:
    """One cleaned table from its own folder, with its declared schema."""
    schema = table_schema(table)
    reader = spark.read.schema(schema).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True).option("escape", '"').option("multiLine", True)
    return reader.load(f"{base}/{table}").select(*schema.names)


def read_news_tables(spark: SparkSession, base: str, fmt: str = "parquet") -> NewsTables:
    return NewsTables(**{name: read_clean(spark, base, name, fmt) for name in TABLE_NAMES})


def catalog_tables(spark: SparkSession, database: str | None = None) -> NewsTables:
    prefix = f"{database}." if database else ""
    return NewsTables(**{name: spark.table(prefix + name) for name in TABLE_NAMES})


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    *,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
) -> DataFrame:
    """A database table; a numeric partition column with bounds reads it in parallel."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **properties)
    if partition_column:
        if bounds is None:
            raise ValueError("bounds are required with a partition column")
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=bounds[0],
            upperBound=bounds[1],
            numPartitions=partitions,
        )
    return reader.load()


def run_sql(
    spark: SparkSession, query: str, tables: NewsTables, args: dict[str, Any] | None = None
) -> DataFrame:
    """A SQL query over the relations ``{events}``, ``{gkg}``, … with ``:name`` arguments."""
    return spark.sql(query, args=args or {}, **tables.named())

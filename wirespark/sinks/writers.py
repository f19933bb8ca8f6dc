"""Writers for cleaned tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wirespark.schemas import CHILD_TABLES, TABLE_NAMES, NewsTables, table_schema

JDBC_BATCH = 10_000


# Folder layout of the base tables: column and, where it is not stored, its value.
LAYOUT = {
    "events": ("sqldate", None),
    "mentions": ("day", "try_cast(mentiontimedate DIV 1000000 AS INT)"),
    "gkg": ("day", "try_cast(substr(date, 1, 8) AS INT)"),
}


def write_clean(
    df: DataFrame,
    base: str,
    table: str,
    fmt: str = "parquet",
    *,
    mode: str = "overwrite",
    by_day: bool = False,
) -> None:
    """Write one table to its own folder, in as many files as its size asks for.

    With ``by_day`` a base table gets one subfolder per day. Rows are rebalanced on
    the day first: small days get one file, and Spark splits a day that is much
    larger than the others over several tasks.
    """
    by = None
    if by_day and table in LAYOUT:
        by, value = LAYOUT[table]
        if value:
            df = df.withColumn(by, F.expr(value))
        df = df.hint("rebalance", by)
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("escape", '"')
    if by:
        writer = writer.partitionBy(by)
    writer.save(f"{base}/{table}")


def create_tables(
    spark: SparkSession, database: str | None = None, *, event_buckets: int | None = None
) -> None:
    """Create the seven tables where they are missing.

    ``event_buckets`` stores events bucketed by their id, so joins on it need not
    shuffle them; take at least ``spark.sql.shuffle.partitions``, or Spark shuffles
    all the same. The other tables are not bucketed: their keys repeat, and a hot key
    in a bucket is read by one task. Keys are not enforced by the catalog; ``orphans``
    and ``duplicate_keys`` check them.
    """
    prefix = f"`{database}`." if database else ""
    for table in TABLE_NAMES:
        columns = ", ".join(
            f"`{field.name}` {field.dataType.simpleString()}" for field in table_schema(table)
        )
        layout = ""
        if event_buckets and table == "events":
            layout = f" CLUSTERED BY (globaleventid) INTO {event_buckets} BUCKETS"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {prefix}`{table}` ({columns}) USING parquet{layout}")


def replace_rows(t: NewsTables, database: str | None = None) -> None:
    """Full refresh of the catalog tables."""
    prefix = f"{database}." if database else ""
    for table, df in t.named().items():
        ordered = df.select(*table_schema(table).names)
        if table == "events":
            # Rows of a bucket meet in few tasks, so a task opens few bucket files.
            ordered = ordered.hint("rebalance", "globaleventid")
        ordered.write.insertInto(prefix + table, overwrite=True)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str],
    *,
    refresh: bool = False,
    connections: int = 8,
) -> None:
    """Append to a database table, or empty it first and keep its definition.

    Rows are shuffled to the connections, so what comes before keeps its own tasks.
    """
    options = jdbc_options(url, table, properties, refresh=refresh, connections=connections)
    df.repartition(connections).write.format("jdbc").mode("overwrite" if refresh else "append").options(**options).save()


def jdbc_options(
    url: str, table: str, properties: dict[str, str], *, refresh: bool, connections: int
) -> dict[str, str]:
    options = {
        "url": url,
        "dbtable": table,
        "batchsize": str(JDBC_BATCH),
        "numPartitions": str(connections),
        **properties,
    }
    if refresh:
        # Parents are emptied before their children are.
        options |= {"truncate": "true", "cascadeTruncate": "true"}
    return options


def load_order() -> list[str]:
    """Parents before children, so foreign keys hold while loading."""
    return ["events", "mentions", "gkg", *CHILD_TABLES]


def load_jdbc(
    t: NewsTables, url: str, properties: dict[str, str], *, refresh: bool = True
) -> None:
    """Load all relations into a database."""
    frames = t.named()
    for table in load_order():
        write_jdbc(frames[table], url, table, properties, refresh=refresh)

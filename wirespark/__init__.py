"""News-event analytics as lazy Spark DataFrame operators.

``functions``  Column -> Column expressions
``operators``  DataFrame -> DataFrame building blocks
``sources``    feed files, archives, tables
``sinks``      Parquet / CSV / catalog / JDBC writers
``plans``      the user-facing queries and batch jobs
``streaming``  incremental ingest of feed drops
"""

from wirespark.schemas import NewsTables

__all__ = ["NewsTables"]

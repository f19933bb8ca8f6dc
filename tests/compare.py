"""Compare every registered query with its SQL in DuckDB.

Usage: python tests/compare.py [data folder] [query …]
"""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry_module  # noqa: E402


SPARK_TYPES = {
    "BOOLEAN": "boolean",
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else float(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    return value


def canonical(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark, connection, sf_dir: str, key: str, sql: str) -> list[str]:
    df = entry_module.queries()[key](spark, sf_dir)
    ours = canonical(df.columns, [tuple(r) for r in df.collect()])
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = canonical(names, cursor.fetchall())
    found = []
    types = {r[0]: r[1] for r in connection.execute(f"DESCRIBE {sql}").fetchall()}
    for name, dtype in df.dtypes:
        if SPARK_TYPES.get(types.get(name)) != dtype:
            found.append(f"type of {name}: {dtype} != {types.get(name)}")
    if sorted(names) != sorted(df.columns):
        found.append(f"columns {sorted(df.columns)} != {sorted(names)}")
    if len(ours) != len(theirs):
        found.append(f"rows {len(ours)} != {len(theirs)}")
    if ours != theirs:
        pairs = [(a, b) for a, b in zip(ours, theirs) if a != b]
        found.append(f"{len(pairs)} differing rows, first {pairs[:1]}")
    return found if found else ([] if ours else ["no rows"])


if __name__ == "__main__":
    from conftest import new_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    session = new_session()
    sqls = entry_module.oracle_sql()
    for key in sys.argv[2:] or entry_module.queries():
        start = time.time()
        try:
            found = differences(session, duck(sf_dir), sf_dir, key, sqls[key])
        except Exception as error:
            found = [str(error)[:1500]]
        print(key, round(time.time() - start, 2), "ok" if not found else found, flush=True)
    session.stop()

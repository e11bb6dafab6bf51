"""Compare a Spark result with DuckDB's, as sets of rows with column types."""

from __future__ import annotations

import datetime as dt
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

TYPES = {
    "VARCHAR": "string", "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz", "SMALLINT": "smallint",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _value(value):
    if isinstance(value, float):
        return f"{value + 0.0:.9g}"
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def _rows(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(row[i]) for i in order) for row in rows)


def differences(df: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    relation = connection.sql(sql)
    expected_types = {c: TYPES.get(str(t), str(t)) for c, t in zip(relation.columns, relation.types)}
    found = []
    if dict(df.dtypes) != expected_types:
        found.append(f"types {dict(df.dtypes)} != {expected_types}")
        if set(df.columns) != set(relation.columns):
            return found
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    wanted = _rows(relation.columns, relation.fetchall())
    if not wanted:
        found.append("no rows expected: the comparison says nothing")
    if got != wanted:
        extra, missing = got - wanted, wanted - got
        found.append(
            f"{sum(got.values())} rows, {sum(wanted.values())} wanted; "
            f"extra {sum(extra.values())} {list(extra)[:3]}; missing {sum(missing.values())} {list(missing)[:3]}"
        )
    return found

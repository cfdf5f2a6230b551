"""Row-by-row comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _plain(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _rows(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    shaped = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(shaped, key=lambda row: [(value is not None, str(value)) for value in row])


def differences(result: DataFrame, connection: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if both have the same columns, kinds of values and rows."""
    found = connection.execute(sql)
    expected_columns = [c[0] for c in found.description]
    expected = _rows(expected_columns, found.fetchall())
    if sorted(result.columns) != sorted(expected_columns):
        return f"columns {sorted(result.columns)} against {sorted(expected_columns)}"
    actual = _rows(result.columns, result.collect())
    if len(actual) != len(expected):
        return f"{len(actual)} rows against {len(expected)}"
    for ours, theirs in zip(actual, expected):
        if ours != theirs:
            return f"{sorted(result.columns)}\n{ours}\n{theirs}"
        if [type(v) for v in ours] != [type(v) for v in theirs]:
            return f"types differ: {ours} {theirs}"
    return None

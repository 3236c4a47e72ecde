"""Comparison of a Spark result with DuckDB's, as multisets of rows."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    return value


def _bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def compare(connection: duckdb.DuckDBPyConnection, df: DataFrame, sql: str) -> tuple[int, list[str]]:
    """Number of rows, and what differs."""
    cursor = connection.execute(sql)
    expected_columns = [d[0] for d in cursor.description]
    expected_types = {d[0]: str(d[1]) for d in cursor.description}
    expected = _bag(expected_columns, cursor.fetchall())
    actual_rows = df.collect()
    actual = _bag(df.columns, actual_rows)
    problems = []
    if sorted(df.columns) != sorted(expected_columns):
        problems.append(f"columns {sorted(df.columns)} / {sorted(expected_columns)}")
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE",
             "timestamp_ntz": "TIMESTAMP"}
    for name, dtype in df.dtypes:
        if kinds.get(dtype) != expected_types.get(name):
            problems.append(f"type of {name}: {dtype} / {expected_types.get(name)}")
    if actual != expected:
        problems.append(f"only Spark {list((actual - expected).items())[:3]}; only SQL {list((expected - actual).items())[:3]}")
    return len(actual_rows), problems

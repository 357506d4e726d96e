"""Comparison of a Spark result with the same query in DuckDB."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')"
        )
    return connection


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return sorted(columns), Counter(tuple(_cell(row[at]) for at in order) for row in rows)


def compare(spark_result, connection, sql: str) -> int:
    """Asserts equal columns and equal rows, exactly and regardless of order; returns the count."""
    relation = connection.sql(sql)
    want_columns, want = _rows(relation.columns, relation.fetchall())
    collected = spark_result.collect()
    got_columns, got = _rows(spark_result.columns, collected)
    assert got_columns == want_columns
    assert got == want, (list((got - want).items())[:5], list((want - got).items())[:5])
    types = dict(zip(relation.columns, map(str, relation.types), strict=True))
    names = {
        "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
        "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
    }
    for name, dtype in spark_result.dtypes:
        assert names[dtype] == types[name], (name, dtype, types[name])
    return len(collected)

"""Compare a Spark result with the DuckDB result of its SQL."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


SQL_TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
             "boolean": "BOOLEAN", "date": "DATE"}


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return str(value)


def difference(frame, connection, sql: str) -> str:
    """Empty when both results hold the same columns and the same rows."""
    result = connection.execute(sql)
    columns = [c[0] for c in result.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    kinds = {c[0]: str(c[1]) for c in result.description}
    other = {name: (kind, kinds[name]) for name, kind in frame.dtypes
             if SQL_TYPES[kind] != kinds[name]}
    if other:
        return f"types {other}"
    order = [columns.index(c) for c in frame.columns]
    expected = sorted(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    found = sorted(tuple(_plain(v) for v in row) for row in frame.collect())
    if len(expected) != len(found):
        return f"{len(found)} rows, expected {len(expected)}"
    wrong = [(a, b) for a, b in zip(found, expected) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else ""

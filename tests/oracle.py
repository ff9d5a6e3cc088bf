"""Compares a query with its SQL run by DuckDB on the same files."""

from __future__ import annotations

import datetime
import decimal
import math
import os

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        if os.path.exists(f"{folder}/{name}.parquet"):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(_plain(row[i]) for i in order) for row in rows], key=lambda t: tuple((v is None, str(v)) for v in t))


def differences(actual: DataFrame, sql: str, connection: duckdb.DuckDBPyConnection) -> list[str]:
    """What differs between the two results: names, kinds of types, row count, first unequal rows."""
    expected = connection.execute(sql)
    names = [d[0] for d in expected.description]
    kinds = {d[0]: str(d[1]) for d in expected.description}
    if sorted(names) != sorted(actual.columns):
        return [f"columns {sorted(actual.columns)} != {sorted(names)}"]
    same = {"bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"}, "boolean": {"BOOLEAN"}}
    found = [f"type of {c}: {t} != {kinds[c]}" for c, t in actual.dtypes if kinds[c] not in same.get(t, {t})]
    left = _sorted([tuple(row) for row in actual.collect()], actual.columns)
    right = _sorted(expected.fetchall(), names)
    if len(left) != len(right):
        found.append(f"rows {len(left)} != {len(right)}")
    unequal = [(a, b) for a, b in zip(left, right) if a != b]
    if unequal:
        found.append(f"{len(unequal)} unequal rows, first {unequal[0][0]} != {unequal[0][1]}")
    return found

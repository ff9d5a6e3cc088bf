"""Registered queries, each with the SQL that states the same result, where SQL can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql.strip()
        return function

    return register


def r(expression: str, digits: int) -> str:
    """SQL for `functions.numbers.rounded`."""
    return f"CAST(ROUND(CAST({expression} AS DECIMAL(30,10)), {digits}) AS DOUBLE)"


def fixed(expression: str, digits: int) -> str:
    """SQL for `functions.numbers.fixed_point`."""
    return f"CAST(CAST(ROUND(CAST({expression} AS DECIMAL(30,10)), {digits}) AS DECIMAL(30,{digits})) AS VARCHAR)"


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + select.strip()

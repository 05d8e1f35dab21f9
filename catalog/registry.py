"""The list of queries, each with its SQL for comparison where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; without `sql` only its rows are checked."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"two queries are named {name}")
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register

"""Where queries and their oracle SQL are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sedimenta.plans.bindings import oracle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query and, if SQL can express it, its oracle; the oracle's views are put in front."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            SQL[name] = oracle(sql)
        return f

    return add

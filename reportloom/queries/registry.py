"""Queries over the test tables and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
CHECKS: dict[str, str] = {}


def query(check: str) -> Callable[[Query], Query]:
    """Register a query under its own name with the SQL for the same result."""

    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        CHECKS[run.__name__] = check
        return run

    return register

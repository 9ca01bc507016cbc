"""Registry of named queries, each next to the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        QUERIES[name or function.__name__] = function
        if sql is not None:
            SQL[name or function.__name__] = sql
        return function

    return add


def six(c: Column | str) -> Column:
    """Rounded for comparison."""
    return F.round(c, 6)


def joined(c: Column | str) -> Column:
    return F.concat_ws("|", c)

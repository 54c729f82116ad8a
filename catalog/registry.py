"""Registry of named queries and, where SQL can express the result, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

DIGITS = 6


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return add


def rounded(df: DataFrame, *columns: str, digits: int = DIGITS) -> DataFrame:
    """Round doubles so that the order of additions does not show in the last digits."""
    return df.withColumns({c: F.round(F.col(c), digits) for c in columns})

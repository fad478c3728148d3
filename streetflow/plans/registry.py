"""The list of queries, filled by the modules that define them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that must give the same rows."""

    def add(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is defined twice")
        QUERIES[name] = build
        if sql is not None:
            SQL[name] = sql
        return build

    return add


def micros(name: str):
    """Time as whole microseconds, the form compared with SQL."""
    return F.unix_micros(name).alias("ts_us")


def big(name: str):
    return F.col(name).cast("bigint").alias(name)


def six(name: str):
    """A figure rounded to six digits, without a negative zero."""
    return (F.round(F.col(name).cast("double"), 6) + F.lit(0.0)).alias(name)


def whole(name: str):
    """A whole number that may be null, as text: clients differ in how they show those."""
    return F.col(name).cast("bigint").cast("string").alias(name)

"""Where the registered queries and their SQL twins are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillcast.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def check(name: str, sql: str | None = None):
    """Register a query; ``sql`` is the same result in plain SQL."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(prepare(spark), sf_dir)

        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def r(c: Column | str, places: int = 6) -> Column:
    """Rounded for comparison; adding 0 turns a negative zero into zero."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, places) + F.lit(0.0)


def rsql(expr: str, alias: str | None = None, places: int = 6) -> str:
    return f"round({expr}, {places}) + 0.0" + (f" AS {alias}" if alias else "")

"""Registry of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from bindscope.plans.views import Campaign, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable:
    """Register ``fn(campaign) -> DataFrame`` and, if given, the SQL that checks it."""

    def wrap(fn: Callable[[Campaign], DataFrame]) -> Callable[[Campaign], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = lambda spark, folder: fn(Campaign(spark, folder))
        if sql is not None:
            ORACLES[name] = oracle(sql)
        return fn

    return wrap

"""Names, queries and check queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from querytrail.plans.standins import Tables, check_sql

Query = Callable[[Tables], DataFrame]
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(name: str, check: str | None = None) -> Callable[[Query], Query]:
    def add(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, folder: function(Tables(spark, folder))
        if check:
            CHECKS[name] = check_sql(check)
        return function

    return add

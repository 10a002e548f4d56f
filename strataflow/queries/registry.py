"""Registered queries, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strataflow.queries.landing import Landing, oracle_ctes

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str, inputs: tuple[str, ...] = ()):
    """Register ``fn(landing)``. ``sql`` may use the named inputs as tables, and
    may start with a comma to go on with further CTEs."""

    def register(fn: Callable[[Landing], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Landing(spark, sf_dir))
        ORACLES[name] = f"{oracle_ctes(*inputs)} {sql.strip()}" if inputs else sql.strip()
        return fn

    return register

"""Named queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from weektide.llm.store import tuned

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{folder}/{table}.parquet")


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with its SQL where SQL can say it."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return fn(tuned(spark), folder)

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register

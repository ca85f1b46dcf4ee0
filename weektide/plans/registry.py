"""Registration of named queries and of the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weektide.session import tune
from weektide.sources.star import transactions

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def plain(df: DataFrame) -> DataFrame:
    """Reduce result types to BIGINT, DOUBLE, BOOLEAN and STRING (dates as ISO text)."""
    out = []
    for field in df.schema.fields:
        col, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DateType):
            col = col.cast("string")
        elif isinstance(kind, T.LongType):
            pass
        elif isinstance(kind, T.IntegralType):
            col = col.cast("bigint")
        elif isinstance(kind, (T.DecimalType, T.FloatType)):
            col = col.cast("double")
        out.append(col.alias(field.name))
    return df.select(*out)


def query(name: str, sql: str | None = None):
    """Register a query under ``name``, with its SQL where SQL can say it."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")

        def run(spark: SparkSession, path: str) -> DataFrame:
            return plain(fn(tune(spark), path))

        run.__name__ = name
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """The transactions view restricted to the columns a query reads."""
    return transactions(spark, path, columns or None)


def series_table(spark: SparkSession, path: str, *keys: str) -> DataFrame:
    """What the weekly table needs, plus series keys."""
    return table(
        spark, path, *keys, "order_date", "order_id", "sales", "profit", "quantity", "discount"
    )

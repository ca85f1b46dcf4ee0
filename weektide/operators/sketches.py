"""Distinct counts from mergeable sketches that are stored beside a table.

A month is sketched once; any span of months, and any coarser grouping, is then counted from
a few kilobytes per month instead of from its rows.
"""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A sketch has 2**LG_K registers: 16 KB, and a standard error of 0.8 %.
LG_K = 14


def standard_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a count from merged sketches."""
    return 1.04 / math.sqrt(1 << lg_k)


def monthly_sketches(
    df: DataFrame,
    columns: list[str],
    keys: list[str] | None = None,
    date_col: str = "order_date",
    lg_k: int = LG_K,
) -> DataFrame:
    """``(keys, month, rows, <column>_sketch ...)``, one row per month.

    Rows without a date belong to no month and are left out; NULLs are not counted as
    values.  Values are sketched as text, so a column may have any simple type.
    """
    dated = df.filter(F.col(date_col).isNotNull())
    month = F.trunc(F.col(date_col).cast("date"), "month").alias("month")
    return dated.groupBy(*(keys or []), month).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.hll_sketch_agg(F.col(c).cast("string"), lg_k).alias(f"{c}_sketch") for c in columns],
    )


def _merged(columns: list[str]):
    return [
        F.sum("rows").alias("rows"),
        *[F.hll_union_agg(f"{c}_sketch").alias(f"{c}_sketch") for c in columns],
    ]


def merge_sketches(
    stored: DataFrame, added: DataFrame, columns: list[str], keys: list[str] | None = None
) -> DataFrame:
    """Stored months with those of later rows; the same rows must not come twice for ``rows``."""
    return stored.unionByName(added).groupBy(*(keys or []), "month").agg(*_merged(columns))


def distinct_from_sketches(
    sketches: DataFrame,
    columns: list[str],
    keys: list[str] | None = None,
    first: date | None = None,
    last: date | None = None,
) -> DataFrame:
    """``(keys, rows, <column> ...)``: estimated distinct values of the months ``first``
    to ``last`` (their days do not matter; both ends belong to the span).

    ``keys`` may be any columns of ``sketches``, so sketches by region give totals as well.
    Without keys there is one row, also for an empty span, with counts of 0.
    """
    months = sketches
    if first is not None:
        months = months.filter(F.col("month") >= F.lit(first.replace(day=1)))
    if last is not None:
        months = months.filter(F.col("month") <= F.lit(last.replace(day=1)))
    counted = [
        F.coalesce(F.hll_sketch_estimate(f"{c}_sketch"), F.lit(0)).cast("bigint").alias(c)
        for c in columns
    ]
    merged = months.groupBy(*(keys or [])).agg(*_merged(columns))
    return merged.select(
        *(keys or []), F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows"), *counted
    )

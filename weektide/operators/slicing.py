"""Slicers and the lists that fill them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def slice_rows(
    df: DataFrame,
    year: int | None = None,
    category: str | None = None,
    segment: str | None = None,
    region: str | None = None,
    date_col: str = "order_date",
) -> DataFrame:
    """Rows matching every slicer that is set.

    A year becomes a date range, which prunes Parquet row groups where a
    ``year(...)`` call could not.
    """
    if year is not None:
        df = df.filter(
            (F.col(date_col) >= F.make_date(F.lit(year), F.lit(1), F.lit(1)))
            & (F.col(date_col) <= F.make_date(F.lit(year), F.lit(12), F.lit(31)))
        )
    for name, value in (("category", category), ("segment", segment), ("region", region)):
        if value is not None:
            df = df.filter(F.col(name) == value)
    return df


def filter_domains(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``(slicer, choice)``: per slicer ``All`` first, then the sorted members."""
    names = list(columns)
    members = (
        df.select(*[c.cast("string").alias(n) for n, c in columns.items()])
        .unpivot([], names, "slicer", "choice")
        .filter(F.col("choice").isNotNull()).distinct()
    )
    everything = df.sparkSession.createDataFrame(
        [(n, "All") for n in names], "slicer string, choice string"
    )
    return members.unionByName(everything).orderBy(
        "slicer", F.col("choice") != "All", "choice"
    )


def losses(df: DataFrame) -> DataFrame:
    """Line items sold below cost."""
    return df.filter(F.col("profit") < 0)


def name_contains(df: DataFrame, column: str, text: str) -> DataFrame:
    return df.filter(F.col(column).contains(text))

"""Gap-free calendar series of any number of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weektide.functions.dates import Frequency
from weektide.functions.numeric import fixed_mean, percent_or_zero, ratio, rnd, total


def series_window(keys: list[str] | None, order: str = "date"):
    """All series windows share this one specification, hence one sort.

    A partition holds the periods of one series, which the calendar bounds;
    windows always come after aggregation to periods.
    """
    return W.partitionBy(*(keys or [])).orderBy(order)


def fill_periods(
    df: DataFrame, frequency: Frequency, keys: list[str], start: str, zero: list[str]
) -> DataFrame:
    """Add the missing buckets between the first and last of each series.

    Each bucket is repeated up to the one before its successor and the copies
    are zeroed.  That needs the window the features use anyway, and neither a
    spine table nor a join.
    """
    successor = F.lead(start).over(series_window(keys, start))
    reach = F.coalesce(F.date_sub(successor, 1), F.col(start))
    grown = df.withColumn("__reach", reach).withColumn(
        "__bucket", F.explode(frequency.starts_between(F.col(start), F.col("__reach")))
    )
    real = F.col("__bucket") == F.col(start)
    filled = grown.withColumns({c: F.when(real, F.col(c)).otherwise(F.lit(0)) for c in zero})
    return filled.withColumn(start, F.col("__bucket")).drop("__bucket", "__reach")


def _resample(
    df: DataFrame, freq: str, keys: list[str], date_col: str, measures: dict[str, Column]
) -> DataFrame:
    frequency = Frequency(freq)
    for name in [date_col, *keys]:
        df = df.filter(F.col(name).isNotNull())
    start = frequency.start(F.col(date_col).cast("date"))
    sums = df.groupBy(*keys, start.alias("__start")).agg(
        *[c.alias(n) for n, c in measures.items()]
    )
    filled = fill_periods(sums, frequency, keys, "__start", list(measures))
    return filled.select(
        *keys, frequency.end(F.col("__start")).alias("date"), *measures
    )


def _measures(df: DataFrame, names: list[str]) -> dict[str, Column]:
    """Aggregates of the named measures that the table has the column for."""
    known = {
        "sales": ("sales", lambda c: total(F.col(c))),
        "profit": ("profit", lambda c: total(F.col(c))),
        "quantity": ("quantity", lambda c: F.coalesce(F.sum(c), F.lit(0))),
        "orders": ("order_id", F.count_distinct),
        "avg_discount": ("discount", lambda c: F.coalesce(fixed_mean(F.col(c)), F.lit(0.0))),
    }
    return {n: known[n][1](known[n][0]) for n in names if known[n][0] in df.columns}


def aggregate_by_time(
    df: DataFrame,
    freq: str = "ME",
    keys: list[str] | None = None,
    date_col: str = "order_date",
) -> DataFrame:
    """Sales, profit, quantity, orders and margin per bucket, gaps as 0.

    A measure is left out when the table has no column for it, so a caller names
    the columns it needs and joins nothing else.
    """
    measures = _measures(df, ["sales", "profit", "quantity", "orders"])
    out = _resample(df, freq, list(keys or []), date_col, measures)
    if "profit" not in measures:
        return out
    return out.withColumn(
        "profit_margin_pct", percent_or_zero(F.col("profit"), F.col("sales"))
    )


def aggregate_to_weekly(
    df: DataFrame,
    keys: list[str] | None = None,
    date_col: str = "order_date",
    drop_partial: bool = False,
) -> DataFrame:
    """The weekly base table: weeks end on Sunday, empty weeks are 0.

    ``drop_partial`` leaves out a first or last week that the data enters or
    leaves midway.  A measure is left out when the table has no column for it.
    """
    keys = list(keys or [])
    measures = _measures(df, ["sales", "profit", "quantity", "orders", "avg_discount"])
    if not drop_partial:
        return _resample(df, "W-SUN", keys, date_col, measures)
    measures["__first"] = F.min(date_col)
    measures["__last"] = F.max(date_col)
    frequency = Frequency("W-SUN")
    for name in [date_col, *keys]:
        df = df.filter(F.col(name).isNotNull())
    sums = df.groupBy(*keys, frequency.start(F.col(date_col)).alias("__start")).agg(
        *[c.alias(n) for n, c in measures.items()]
    )
    spans = W.partitionBy(*keys)
    first, last = F.min("__first").over(spans), F.max("__last").over(spans)
    whole = sums.withColumns({"__from": first, "__to": last}).filter(
        (F.col("__start") >= F.col("__from")) & (F.date_add("__start", 6) <= F.col("__to"))
    ).drop("__first", "__last", "__from", "__to")
    names = [m for m in measures if not m.startswith("__")]
    filled = fill_periods(whole, frequency, keys, "__start", names)
    return filled.select(*keys, frequency.end(F.col("__start")).alias("date"), *names)


def active_days(df: DataFrame, date_col: str = "order_date") -> DataFrame:
    """One row: days in the span, days with sales, and both shares."""
    daily = aggregate_by_time(df.drop("order_id"), "D", [], date_col)
    days, active = F.count(F.lit(1)), F.count_if(F.col("sales") != 0)
    return daily.agg(
        days.alias("span_days"), active.alias("active_days"),
        F.round(active * 100.0 / days, 2).cast("double").alias("active_pct"),
        F.round((days - active) * 100.0 / days, 2).cast("double").alias("zero_pct"),
    )


def peak_ratio(weekly: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Best week against the median week of each series."""
    peak, middle = F.max("sales"), F.percentile("sales", 0.5)
    return weekly.groupBy(*(keys or [])).agg(
        rnd(peak, 2).alias("peak_sales"), rnd(middle, 2).alias("median_sales"),
        rnd(ratio(peak, middle), 2).alias("peak_ratio"),
    )

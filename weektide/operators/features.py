"""Weekly predictors: the only feature builder, for training and for serving.

Every lag and rolling statistic of week *t* reads weeks before *t* only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weektide.functions.dates import calendar_columns
from weektide.functions.numeric import rnd
from weektide.operators.resample import aggregate_to_weekly, series_window
from weektide.schema import LAG_STEPS, SAME_WEEK_COLUMNS, TARGET_COLUMNS

#: Driver predictors: name -> (weekly column, digits kept).
DRIVER_LAGS = {
    "orders_lag_1": ("orders", None),
    "quantity_lag_1": ("quantity", None),
    "profit_lag_1": ("profit", 2),
    "avg_discount_lag_1": ("avg_discount", 4),
}


def calendar_features(weekly: DataFrame, date_col: str = "date") -> DataFrame:
    return weekly.withColumns(calendar_columns(F.col(date_col)))


def lag_features(
    weekly: DataFrame, keys: list[str] | None = None, lags: list[int] | None = None
) -> DataFrame:
    """``sales_lag_k`` for each step; needs a gap-free series."""
    w = series_window(keys)
    steps = LAG_STEPS if lags is None else lags
    return weekly.withColumns({f"sales_lag_{k}": F.lag("sales", k).over(w) for k in steps})


def rolling_features(weekly: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Statistics of the 4 and 12 weeks before each week; NULL until all are there."""
    w = series_window(keys)

    def before(width: int, stat: Column) -> Column:
        frame = w.rowsBetween(-width, -1)
        full = F.count("sales").over(frame) == width
        return rnd(F.when(full, stat.over(frame)), 2)

    return weekly.withColumns(
        {
            "sales_rolling_mean_4": before(4, F.avg("sales")),
            "sales_rolling_std_4": before(4, F.stddev_samp("sales")),
            "sales_rolling_min_4": before(4, F.min("sales")),
            "sales_rolling_max_4": before(4, F.max("sales")),
            "sales_rolling_mean_12": before(12, F.avg("sales")),
            "sales_rolling_std_12": before(12, F.stddev_samp("sales")),
        }
    )


def business_lags(weekly: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Last week's drivers; the same-week originals are dropped."""
    w = series_window(keys)
    out = {}
    for name, (source, digits) in DRIVER_LAGS.items():
        value = F.lag(F.col(source).cast("double"), 1).over(w)
        out[name] = value if digits is None else rnd(value, digits)
    lagged = weekly.withColumns(out)
    return lagged.drop(*[c for c in SAME_WEEK_COLUMNS if c in lagged.columns])


def features_from_weekly(
    weekly: DataFrame, keys: list[str] | None = None, drop_incomplete: bool = True
) -> DataFrame:
    """All 26 predictors of a gap-free weekly table, plus ``log_sales``."""
    out = calendar_features(weekly)
    out = lag_features(out, keys)
    out = rolling_features(out, keys)
    out = business_lags(out, keys)
    out = out.withColumn("log_sales", rnd(F.log1p("sales"), 4))
    return out.na.drop() if drop_incomplete else out


def build_features(
    transactions: DataFrame,
    keys: list[str] | None = None,
    drop_incomplete: bool = True,
    date_col: str = "order_date",
) -> DataFrame:
    """Transactions to the feature table, one series per combination of ``keys``."""
    weekly = aggregate_to_weekly(transactions, keys, date_col)
    return features_from_weekly(weekly, keys, drop_incomplete)


def feature_columns(features: DataFrame, keys: list[str] | None = None) -> list[str]:
    """Predictor names: everything but target, keys and split bookkeeping."""
    other = {*TARGET_COLUMNS, *(keys or []), "role", "fold", "row_no", "n_rows", "prediction"}
    return [c for c in features.columns if c not in other]


def feature_summary(features: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per series: weeks aggregated, complete rows, rows lost to warm-up, span.

    Takes the table built with ``drop_incomplete=False``.
    """
    names = feature_columns(features, keys)
    complete = F.lit(True)
    for c in names:
        complete = complete & F.col(c).isNotNull()
    weeks, rows = F.count(F.lit(1)), F.count_if(complete)
    when_complete = F.when(complete, F.col("date"))
    return features.groupBy(*(keys or [])).agg(
        weeks.alias("total_weeks_aggregated"),
        rows.alias("final_rows"),
        (weeks - rows).alias("rows_dropped_for_lags"),
        F.max(F.lit(len(names))).alias("total_features"),
        F.min(when_complete).alias("start"),
        F.max(when_complete).alias("end"),
    )


def autocorrelation(
    weekly: DataFrame, keys: list[str] | None = None, lags: tuple[int, ...] = (1, 2, 4, 52)
) -> DataFrame:
    """Correlation of sales with its own lags."""
    keys = list(keys or [])
    lagged = lag_features(weekly, keys, list(lags))
    one = lagged.groupBy(*keys).agg(
        *[rnd(F.corr("sales", f"sales_lag_{k}"), 4).alias(str(k)) for k in lags]
    )
    return one.unpivot(keys, [str(k) for k in lags], "lag", "r").withColumn(
        "lag", F.col("lag").cast("int")
    )

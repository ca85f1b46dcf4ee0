"""Calendar series, predictors and the leakage audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from weektide.operators import features as FE
from weektide.operators import leakage, resample
from weektide.plans import sql as S
from weektide.plans.registry import query, series_table, table

_DATE = "CAST(date AS VARCHAR) AS date"


def _totals_sql(bucket: str, spine: str, keys: tuple[str, ...] = ()) -> str:
    """Sales, profit, quantity, orders and margin per bucket on a full calendar."""
    ks = "".join(f"{k}, " for k in keys)
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    using = ", ".join([*keys, "date"])
    return f"""{S.WITH_T}, b AS (
  SELECT {ks}{bucket} AS date, CAST(sum(sales) AS DOUBLE) AS sales,
         CAST(sum(profit) AS DOUBLE) AS profit, CAST(sum(quantity) AS BIGINT) AS quantity,
         count(DISTINCT order_id) AS orders
  FROM t GROUP BY {using}
), spine AS (SELECT {ks}{spine} AS date FROM b {group}),
g AS (SELECT {ks}date, coalesce(sales, 0.0) AS sales, coalesce(profit, 0.0) AS profit,
       coalesce(quantity, 0) AS quantity, coalesce(orders, 0) AS orders
  FROM spine LEFT JOIN b USING ({using}))
SELECT * REPLACE ({_DATE.replace(' AS date', '')} AS date),
       {S.pct0('profit', 'sales')} AS profit_margin_pct FROM g"""


def _days(step: str) -> str:
    return f"CAST(unnest(generate_series(min(date), max(date), INTERVAL {step})) AS DATE)"


_WEEK = "CAST(date_trunc('week', order_date) AS DATE) + 6"
_MONTHS = (
    "last_day(CAST(unnest(generate_series(date_trunc('month', min(date)), max(date),"
    " INTERVAL 1 MONTH)) AS DATE))"
)


@query("daily_sales", _totals_sql("order_date", _days("1 DAY")))
def _(spark, path):
    t = table(spark, path, "order_date", "order_id", "sales", "profit", "quantity")
    return resample.aggregate_by_time(t, "D")


@query("weekly_sales", _totals_sql(_WEEK, _days("7 DAY")))
def _(spark, path):
    t = table(spark, path, "order_date", "order_id", "sales", "profit", "quantity")
    return resample.aggregate_by_time(t, "W-SUN")


@query("monthly_totals", _totals_sql("last_day(order_date)", _MONTHS))
def _(spark, path):
    t = table(spark, path, "order_date", "order_id", "sales", "profit", "quantity")
    return resample.aggregate_by_time(t, "ME")


@query(
    "quarterly_totals_by_region",
    _totals_sql(
        "CAST(date_trunc('quarter', order_date) AS DATE)", _days("3 MONTH"), ("region",)
    ).replace(
        "CAST(date AS VARCHAR) AS date",
        "CAST(CAST(date + INTERVAL 3 MONTH AS DATE) - 1 AS VARCHAR) AS date",
    ),
)
def _(spark, path):
    t = table(spark, path, "region", "order_date", "order_id", "sales", "profit", "quantity")
    return resample.aggregate_by_time(t, "QE", ["region"])


@query("daily_sales_by_state", _totals_sql("order_date", _days("1 DAY"), ("state",)))
def _(spark, path):
    t = table(spark, path, "state", "order_date", "order_id", "sales", "profit", "quantity")
    return resample.aggregate_by_time(t, "D", ["state"])


def _weekly_sql(keys: list[str]) -> str:
    return (
        S.weekly(keys)
        + f"SELECT * REPLACE (CAST(date AS VARCHAR) AS date, {S.rnd('avg_discount', 6)} AS avg_discount) FROM w"
    )


def _features_sql(keys: list[str]) -> str:
    integers = ["year", "quarter", "month", "week_of_year", "is_q4"]
    casts = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in integers)
    return S.features(keys) + f"SELECT * REPLACE (CAST(date AS VARCHAR) AS date, {casts}) FROM f"


def _weekly(spark, path, keys):
    out = resample.aggregate_to_weekly(series_table(spark, path, *keys), keys)
    return out.withColumn("avg_discount", FE.rnd(F.col("avg_discount"), 6))


_SERIES = {
    "": [],
    "_by_category": ["category"],
    "_by_region": ["region"],
    "_by_subcategory": ["category", "sub_category"],
}


def _register(suffix: str, keys: list[str]) -> None:
    query(f"weekly_base{suffix}", _weekly_sql(keys))(
        lambda spark, path: _weekly(spark, path, keys)
    )
    query(f"features{suffix}", _features_sql(keys))(
        lambda spark, path: FE.build_features(series_table(spark, path, *keys), keys)
    )


for _suffix, _keys in _SERIES.items():
    _register(_suffix, _keys)


@query(
    "active_days",
    f"""{S.WITH_T}, a AS (SELECT CAST(max(order_date) - min(order_date) + 1 AS BIGINT) AS span_days,
       count(DISTINCT order_date) FILTER (sales <> 0) AS active_days FROM t)
SELECT *, {S.rnd('active_days * 100.0::DOUBLE / span_days')} AS active_pct,
       {S.rnd('(span_days - active_days) * 100.0::DOUBLE / span_days')} AS zero_pct FROM a""",
)
def _(spark, path):
    return resample.active_days(table(spark, path, "order_date", "sales"))


@query(
    "peak_ratio",
    S.weekly(["category"]) + f"""SELECT category, {S.rnd('max(sales)')} AS peak_sales,
       {S.rnd('quantile_cont(sales, 0.5)')} AS median_sales,
       {S.rnd('max(sales) / nullif(quantile_cont(sales, 0.5), 0)')} AS peak_ratio FROM w GROUP BY 1""",
)
def _(spark, path):
    keys = ["category"]
    weekly = resample.aggregate_to_weekly(series_table(spark, path, *keys), keys)
    return resample.peak_ratio(weekly, keys)


@query(
    "lag_features",
    S.weekly() + f"SELECT {_DATE}, sales, {S.lag_list([])} FROM w",
)
def _(spark, path):
    weekly = resample.aggregate_to_weekly(table(spark, path, "order_date", "sales"))
    return FE.lag_features(weekly)


@query(
    "rolling_features",
    S.weekly(["region"]) + f"SELECT region, {_DATE}, sales, {S.rolling_list(['region'])} FROM w",
)
def _(spark, path):
    t = table(spark, path, "region", "order_date", "sales")
    return FE.rolling_features(resample.aggregate_to_weekly(t, ["region"]), ["region"])


@query(
    "business_lags",
    S.weekly() + f"SELECT {_DATE}, sales, {S.driver_list([])} FROM w",
)
def _(spark, path):
    return FE.business_lags(resample.aggregate_to_weekly(series_table(spark, path)))


@query(
    "calendar_features",
    S.weekly() + f"SELECT CAST(date AS VARCHAR) AS date, {S.CALENDAR} FROM w".replace(
        "CASE WHEN month(date) >= 9 THEN 1 ELSE 0 END AS is_q4",
        "CAST(CASE WHEN month(date) >= 9 THEN 1 ELSE 0 END AS BIGINT) AS is_q4",
    ),
)
def _(spark, path):
    weekly = resample.aggregate_to_weekly(table(spark, path, "order_date", "sales")).select("date")
    return FE.calendar_features(weekly)


_COMPLETE = "sales_lag_52 IS NOT NULL"


@query(
    "features_complete",
    S.weekly(["category"]) + f""", x AS (SELECT *, lag(sales, 52) OVER ({S.over(['category'])}) AS sales_lag_52 FROM w)
SELECT category, count(*) AS total_weeks_aggregated,
       count(*) FILTER ({_COMPLETE}) AS final_rows,
       count(*) FILTER (sales_lag_52 IS NULL) AS rows_dropped_for_lags,
       CAST(26 AS BIGINT) AS total_features,
       CAST(min(date) FILTER ({_COMPLETE}) AS VARCHAR) AS start,
       CAST(max(date) FILTER ({_COMPLETE}) AS VARCHAR) AS "end" FROM x GROUP BY 1""",
)
def _(spark, path):
    keys = ["category"]
    whole = FE.build_features(series_table(spark, path, *keys), keys, drop_incomplete=False)
    return FE.feature_summary(whole, keys)


@query(
    "autocorrelation",
    S.weekly(["category"]) + f""", x AS (SELECT *, {S.lag_list(['category'])} FROM w)
""" + " UNION ALL ".join(
        f"""SELECT category, CAST({k} AS BIGINT) AS lag, {S.rnd(f'corr(sales, sales_lag_{k})', 4)} AS r
FROM x GROUP BY 1""" for k in (1, 2, 4, 52)
    ),
)
def _(spark, path):
    keys = ["category"]
    weekly = resample.aggregate_to_weekly(series_table(spark, path, *keys), keys)
    return FE.autocorrelation(weekly, keys)


def _features(spark, path, keys=()):
    return FE.build_features(series_table(spark, path, *keys), list(keys))


_STEP = "date - lag(date) OVER (ORDER BY date)"


@query(
    "cadence_check",
    S.features() + f""", x AS (SELECT *, {_STEP} AS step FROM f)
SELECT count(*) AS total_rows, count(*) - count(DISTINCT date) AS duplicate_dates,
       min(step) >= 0 AS is_monotonic, bool_and(step = 7) AS is_uniform FROM x""",
)
def _(spark, path):
    return leakage.cadence(_features(spark, path))


def _close(a: str, b: str, atol: float) -> str:
    return f"abs({a} - {b}) <= {atol} + 1e-5 * abs({b})"


def _audit_columns(keys: list[str]) -> str:
    o = S.over(keys)
    return f"""SELECT *, date - lag(date) OVER ({o}) AS step,
       lag(sales) OVER ({o}) AS before, lag(sales, 4) OVER ({o}) AS oldest,
       lead(sales) OVER ({o}) AS ahead,
       avg(sales) OVER ({o} ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS shifted,
       avg(sales) OVER ({o} ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS unshifted FROM f"""


_ALIGNED = f"bool_and({_close('sales_lag_1', 'before', 1e-2)}) FILTER (before IS NOT NULL)"
_SHIFTED = (
    f"bool_and({_close('shifted', 'sales_rolling_mean_4', 1e-1)}) FILTER (oldest IS NOT NULL)"
)
_HELD = (
    f"bool_or({_close('unshifted', 'sales_rolling_mean_4', 1e-1)}"
    f" AND NOT {_close('sales', 'oldest', 1e-1)}) FILTER (oldest IS NOT NULL)"
)


@query(
    "leakage_lag",
    S.features() + f""", x AS ({_audit_columns([])})
SELECT count(before) AS compared, {_ALIGNED} AS lag_1_aligned FROM x""",
)
def _(spark, path):
    return leakage.lag_alignment(_features(spark, path))


@query(
    "leakage_rolling",
    S.features() + f""", x AS ({_audit_columns([])})
SELECT count(oldest) AS compared, {_SHIFTED} AS rolling_shifted, {_HELD} AS target_in_rolling FROM x""",
)
def _(spark, path):
    return leakage.rolling_shift(_features(spark, path))


_PREDICTORS = [
    "year", "quarter", "month", "week_of_year", "is_q4", "sin_week", "cos_week", "sin_month",
    "cos_month", *[f"sales_lag_{k}" for k in S.LAGS], "sales_rolling_mean_4",
    "sales_rolling_std_4", "sales_rolling_min_4", "sales_rolling_max_4",
    "sales_rolling_mean_12", "sales_rolling_std_12", "orders_lag_1", "quantity_lag_1",
    "profit_lag_1", "avg_discount_lag_1",
]


@query(
    "leakage_future_corr",
    S.features(["region"]) + f""", x AS ({_audit_columns(['region'])})
""" + " UNION ALL ".join(
        f"""SELECT region, '{c}' AS feature, {S.rnd(f'corr({c}, ahead)', 4)} AS r,
       abs(corr({c}, ahead)) > 0.95 AS over_threshold FROM x GROUP BY 1"""
        for c in _PREDICTORS
    ),
)
def _(spark, path):
    return leakage.future_correlation(_features(spark, path, ["region"]), ["region"])


_OVER = " + ".join(f"CAST(abs(corr({c}, ahead)) > 0.95 AS BIGINT)" for c in _PREDICTORS)


def _audit_sql(keys: list[str]) -> str:
    ks = "".join(f"{k}, " for k in keys)
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    return S.features(keys) + f""", x AS ({_audit_columns(keys)}),
c AS (SELECT {ks}count(*) AS total_rows, count(*) - count(DISTINCT date) AS duplicate_dates,
       min(step) >= 0 AS is_monotonic, bool_and(step = 7) AS is_uniform,
       {_ALIGNED} AS lag_1_aligned, {_SHIFTED} AS rolling_shifted, {_HELD} AS target_in_rolling,
       {_OVER} AS future_correlations FROM x {group}),
v AS (SELECT *, '' AS forbidden_columns, CAST(26 AS BIGINT) AS feature_count,
       is_monotonic AND is_uniform AND duplicate_dates = 0 AND lag_1_aligned AND rolling_shifted
       AND NOT target_in_rolling AND future_correlations = 0 AS passed FROM c)
SELECT *, CASE WHEN passed THEN 'NO TARGET LEAKAGE DETECTED' ELSE 'TARGET LEAKAGE DETECTED' END AS verdict
FROM v"""


@query("leakage_audit", _audit_sql([]))
def _(spark, path):
    return leakage.audit(_features(spark, path))


@query("leakage_audit_by_category", _audit_sql(["category"]))
def _(spark, path):
    return leakage.audit(_features(spark, path, ["category"]), ["category"])

"""Splits, baselines, metrics and residual diagnostics.

Diagnostics run on the seasonal-naive forecast of the test year, so SQL can
check every number.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from weektide.functions.numeric import rnd
from weektide.operators import evaluate as E
from weektide.operators import residuals as R
from weektide.operators.features import build_features
from weektide.operators.forecast import forecast_summary, holdout_table
from weektide.plans import sql as S
from weektide.plans.registry import query, series_table
from weektide.sources.durable import durable

TEST_YEAR = 2001
_DATE = "CAST(date AS VARCHAR) AS date"


def _features(spark, path, keys=()):
    return build_features(series_table(spark, path, *keys), list(keys))


def _stored(spark, path, keys=()):
    """The feature table, stored where a query reads it more than once."""
    return durable(_features(spark, path, keys))


def _train(features):
    return E.chronological_split(features, TEST_YEAR).filter("role = 'train'").drop("role")


@query(
    "chrono_split",
    S.split(TEST_YEAR) + f"SELECT {_DATE}, sales, role FROM s",
)
def _(spark, path):
    return E.chronological_split(_features(spark, path), TEST_YEAR).select("date", "sales", "role")


@query(
    "cv_folds",
    S.folds(TEST_YEAR, ["region"]) + f"SELECT region, fold, {_DATE}, sales, role FROM cv",
)
def _(spark, path):
    folded = E.expanding_folds(_train(_features(spark, path, ["region"])), 5, ["region"])
    return folded.select("region", "fold", "date", "sales", "role")


def _span(side: str) -> str:
    f = f"FILTER (role = '{side}')"
    return (
        f"CAST(min(date) {f} AS VARCHAR) AS {side}_start, CAST(max(date) {f} AS VARCHAR) AS {side}_end,"
        f" count(*) {f} AS {side}_n"
    )


@query(
    "fold_periods",
    S.folds(TEST_YEAR) + f"""SELECT fold, {_span('train')}, {_span('val')},
       max(date) FILTER (role = 'train') < min(date) FILTER (role = 'val') AS chronological
FROM cv GROUP BY 1""",
)
def _(spark, path):
    return E.fold_periods(E.expanding_folds(_train(_features(spark, path)), 5))


_TEST = S.split(TEST_YEAR) + ", x AS (SELECT * FROM s WHERE role = 'test')\n"


@query("naive_metrics", _TEST + f"SELECT {S.metrics(p='sales_lag_1')} FROM x")
def _(spark, path):
    test = E.chronological_split(_features(spark, path), TEST_YEAR).filter("role = 'test'")
    return E.forecast_metrics(test, predicted="sales_lag_1")


@query("seasonal_naive_metrics", _TEST + f"SELECT {S.metrics(p='sales_lag_52')} FROM x")
def _(spark, path):
    test = E.chronological_split(_features(spark, path), TEST_YEAR).filter("role = 'test'")
    return E.forecast_metrics(test, predicted="sales_lag_52")


@query(
    "forecast_metrics",
    S.split(TEST_YEAR, ["category", "sub_category"]) + f""", x AS (SELECT * FROM s WHERE role = 'test'),
p AS ({S.baselines('x')})
SELECT category, sub_category, model, {S.metrics()} FROM p GROUP BY ALL""",
)
def _(spark, path):
    keys = ["category", "sub_category"]
    return E.baseline_metrics(_features(spark, path, keys), TEST_YEAR, keys)


_FOLD_METRICS = (
    S.folds(TEST_YEAR)
    + f""", v AS (SELECT * FROM cv WHERE role = 'val'), p AS ({S.baselines('v')}),
m AS (SELECT fold, model, {S.metrics()} FROM p GROUP BY ALL)
"""
)


@query(
    "baseline_eval",
    _FOLD_METRICS + f""", x AS (SELECT * FROM s WHERE role = 'test'), q AS ({S.baselines('x')}),
tm AS (SELECT model, {S.metrics()} FROM q GROUP BY 1),
cm AS (SELECT model, {', '.join(S.rnd(f'avg({m})') + f' AS cv_{m}' for m in E.METRICS)} FROM m GROUP BY 1)
SELECT cm.*, {', '.join(f'tm.{m} AS test_{m}' for m in E.METRICS)} FROM cm JOIN tm USING (model)""",
)
def _(spark, path):
    return E.evaluate_baselines(_stored(spark, path), TEST_YEAR)


@query(
    "backtest_baselines",
    _FOLD_METRICS + f""", per AS (SELECT fold, {_span('train')}, {_span('val')} FROM cv GROUP BY 1)
SELECT fold, train_start || ' to ' || train_end AS train_period, train_n,
       val_start || ' to ' || val_end AS val_period, val_n, model, mae, rmse, mape, wape
FROM per JOIN m USING (fold)""",
)
def _(spark, path):
    train = _train(_stored(spark, path))
    return E.backtest_table(E.expanding_folds(train, 5), E.baseline_folds(train, 5))


@query(
    "backtest_summary",
    _FOLD_METRICS + f"""SELECT model, {S.rnd('avg(mae)')} AS mean_mae,
       {S.rnd('quantile_cont(mae, 0.5)')} AS median_mae, {S.rnd('stddev_samp(mae)')} AS std_mae,
       {S.rnd('avg(rmse)')} AS mean_rmse, {S.rnd('avg(mape)')} AS mean_mape,
       {S.rnd('avg(wape)')} AS mean_wape FROM m GROUP BY 1""",
)
def _(spark, path):
    return E.backtest_summary(E.baseline_folds(_train(_features(spark, path)), 5))


@query(
    "cv_summary_baselines",
    _FOLD_METRICS + f"""SELECT model,
       {', '.join(S.rnd(f'avg({m})') + f' AS cv_{m}' for m in E.METRICS)},
       {S.rnd('stddev_pop(mae)')} AS cv_mae_std, {S.rnd('stddev_pop(rmse)')} AS cv_rmse_std
FROM m GROUP BY 1""",
)
def _(spark, path):
    return E.mean_of_folds(E.baseline_folds(_train(_features(spark, path)), 5))


def _seasonal(spark, path, keys=()):
    """Test-year rows with the value of 52 weeks earlier as the prediction."""
    split = E.chronological_split(_features(spark, path, keys), TEST_YEAR)
    return split.filter("role = 'test'").withColumn("prediction", F.col("sales_lag_52"))


def _pred(keys: list[str]) -> str:
    return S.split(TEST_YEAR, keys) + """, x AS (
  SELECT *, sales_lag_52 AS prediction, sales - sales_lag_52 AS e FROM s WHERE role = 'test')
"""


def _errors(keys: list[str]) -> str:
    """CTEs up to ``er``: the error rows."""
    ks = "".join(f"{k}, " for k in keys)
    part = f"PARTITION BY {', '.join(keys)}" if keys else ""
    return _pred(keys) + f""", q AS (
  SELECT *, quantile_cont(sales, 0.25) OVER ({part}) AS q25,
         quantile_cont(sales, 0.75) OVER ({part}) AS q75 FROM x
), er AS (
  SELECT {ks}date, {S.rnd('sales')} AS actual, {S.rnd('prediction')} AS predicted,
         {S.rnd('e')} AS residual, {S.rnd('abs(e)')} AS absolute_error,
         {S.rnd('abs(e) / nullif(sales, 0) * 100')} AS ape_pct,
         month(date) AS month, quarter(date) AS quarter, weekofyear(date) AS week,
         CASE WHEN sales < q25 THEN '{R.TIER_LOW}' WHEN sales > q75 THEN '{R.TIER_HIGH}'
              ELSE '{R.TIER_NORMAL}' END AS sales_tier
  FROM q
)
"""


_ROW = "* REPLACE (CAST(date AS VARCHAR) AS date)"


@query("error_rows", _errors([]) + f"SELECT {_ROW} FROM er")
def _(spark, path):
    return R.error_rows(_seasonal(spark, path))


@query("error_rows_by_category", _errors(["category"]) + f"SELECT {_ROW} FROM er")
def _(spark, path):
    keys = ["category"]
    return R.error_rows(_seasonal(spark, path, keys), keys)


@query(
    "sales_tiers",
    _errors([]) + "SELECT sales_tier, count(*) AS weeks, min(actual) AS lowest, max(actual) AS highest FROM er GROUP BY 1",
)
def _(spark, path):
    return R.error_rows(_seasonal(spark, path)).groupBy("sales_tier").agg(
        F.count("actual").alias("weeks"), F.min("actual").alias("lowest"),
        F.max("actual").alias("highest"),
    )


_DIRECTION = f"CASE WHEN residual > 0 THEN '{R.UNDER}' ELSE '{R.OVER}' END AS error_direction"


@query(
    "worst_forecasts",
    _errors([]) + f"SELECT {_ROW}, {_DIRECTION} FROM er ORDER BY absolute_error DESC, er.date LIMIT 10",
)
def _(spark, path):
    return R.worst_forecasts(R.error_rows(_seasonal(spark, path)))


@query(
    "worst_forecasts_by_category",
    _errors(["category"]) + f"""SELECT {_ROW}, {_DIRECTION} FROM er
QUALIFY row_number() OVER (PARTITION BY category ORDER BY absolute_error DESC, er.date) <= 3""",
)
def _(spark, path):
    keys = ["category"]
    return R.worst_forecasts(R.error_rows(_seasonal(spark, path, keys), keys), 3, keys)


def _breakdown(by: str, keys: list[str] | None = None) -> str:
    ks = "".join(f"{k}, " for k in keys or [])
    return _errors(keys or []) + f"""SELECT {ks}{by}, count(actual) AS "count",
       {S.rnd('avg(actual)')} AS mean_actual, {S.rnd('avg(predicted)')} AS mean_predicted,
       {S.rnd('avg(absolute_error)')} AS mean_mae, {S.rnd('avg(residual)')} AS mean_residual,
       {S.rnd('sum(absolute_error) / nullif(sum(actual), 0) * 100')} AS mean_wape
FROM er GROUP BY ALL"""


@query("error_by_quarter", _breakdown("quarter"))
def _(spark, path):
    return R.error_breakdown(R.error_rows(_seasonal(spark, path)), "quarter")


@query("error_by_tier", _breakdown("sales_tier"))
def _(spark, path):
    return R.error_breakdown(R.error_rows(_seasonal(spark, path)), "sales_tier")


@query("error_by_month", _breakdown("month"))
def _(spark, path):
    return R.error_breakdown(R.error_rows(_seasonal(spark, path)), "month")


@query("error_by_month_by_region", _breakdown("month", ["region"]))
def _(spark, path):
    keys = ["region"]
    return R.error_breakdown(R.error_rows(_seasonal(spark, path, keys), keys), "month", keys)


_M2 = "(avg(e * e) - avg(e) * avg(e))"
_SKEW = f"""(avg(e * e * e) - 3 * avg(e) * avg(e * e) + 2 * avg(e) * avg(e) * avg(e))
       / pow({_M2}, 1.5)"""


@query(
    "residual_stats",
    _pred([]) + f"""SELECT count(e) AS n, {S.rnd('quantile_cont(sales, 0.25)')} AS q25_threshold,
       {S.rnd('quantile_cont(sales, 0.75)')} AS q75_threshold, {S.rnd('avg(e)')} AS mean_residual,
       {S.rnd('stddev_pop(e)')} AS std_residual, {S.rnd(_SKEW, 3)} AS skewness,
       {S.rnd('avg(e) / (stddev_samp(e) / sqrt(count(e)))', 4)} AS t_test_stat FROM x""",
)
def _(spark, path):
    return R.residual_stats(_seasonal(spark, path))


@query(
    "residual_ttest",
    _pred(["category"]) + f"""SELECT category, count(e) AS n,
       {S.rnd('avg(e) / (stddev_samp(e) / sqrt(count(e)))', 4)} AS t_test_stat FROM x GROUP BY 1""",
)
def _(spark, path):
    keys = ["category"]
    return R.residual_ttest(_seasonal(spark, path, keys), keys).drop("t_test_pval")


@query("residual_ttest_pvalue")
def _(spark, path):
    keys = ["category"]
    return R.residual_ttest(_seasonal(spark, path, keys), keys)


@query("shapiro")
def _(spark, path):
    keys = ["category"]
    return R.shapiro_wilk(_seasonal(spark, path, keys), keys)


def _polynomial(coefficients, x: str) -> str:
    """Horner's scheme in SQL, highest power first."""
    out = f"{float(coefficients[0])!r}::DOUBLE"
    for c in coefficients[1:]:
        out = f"({out} * ({x}) + {S.dbl(repr(float(c)))})"
    return out


def _quantile(p: str) -> str:
    """The standard normal quantile in SQL, by the coefficients of ``residuals``."""
    def ratio(part: str, x: str) -> str:
        above, below = (_polynomial(c[::-1], x) for c in R._QUANTILE[part])
        return f"{above} / {below}"

    q, tail = f"(({p}) - 0.5)", f"sqrt(-ln(least({p}, 1 - ({p}))))"
    return f"""(CASE WHEN abs({q}) <= 0.425 THEN {q} * {ratio('middle', f'0.180625 - {q} * {q}')}
      WHEN {tail} <= 5 THEN sign({q}) * {ratio('tail', f'{tail} - 1.6')}
      ELSE sign({q}) * {ratio('far', f'{tail} - 5')} END)"""


@query(
    "shapiro_w",
    _pred(["category"]) + f""", r1 AS (
  SELECT category, e, CAST(row_number() OVER (PARTITION BY category ORDER BY e) AS DOUBLE) AS i,
         CAST(count(*) OVER (PARTITION BY category) AS DOUBLE) AS k FROM x WHERE e IS NOT NULL
), m1 AS (
  SELECT *, {_quantile('(i - 0.375) / (k + 0.25)')} AS m FROM r1
), s1 AS (
  SELECT category, k, sum(m * m) AS mm, sum(m * e) FILTER (i > 2 AND i < k - 1) AS inside,
         max(m) FILTER (i = k) AS m1, max(m) FILTER (i = k - 1) AS m2,
         max(e) FILTER (i = 1) AS x1, max(e) FILTER (i = 2) AS x2,
         max(e) FILTER (i = k - 1) AS y2, max(e) FILTER (i = k) AS y1,
         var_pop(e) * count(*) AS squares FROM m1 GROUP BY ALL
), u1 AS (
  SELECT *, {_polynomial((*R._LAST, 0.0), '1 / sqrt(k)')} + m1 / sqrt(mm) AS last,
         {_polynomial((*R._SECOND, 0.0), '1 / sqrt(k)')} + m2 / sqrt(mm) AS second FROM s1
), w1 AS (
  SELECT *, (mm - 2 * m1 * m1 - 2 * m2 * m2) / (1 - 2 * last * last - 2 * second * second) AS phi FROM u1
)
SELECT category, CAST(k AS BIGINT) AS n,
       {S.rnd('power(last * (y1 - x1) + second * (y2 - x2) + inside / sqrt(phi), 2) / squares', 4)} AS shapiro_stat
FROM w1""",
)
def _(spark, path):
    keys = ["category"]
    return R.shapiro_wilk(_seasonal(spark, path, keys), keys).drop("shapiro_pval")


@query(
    "durbin_watson",
    _pred(["category"]) + f""", d AS (SELECT *, e - lag(e) OVER ({S.over(['category'])}) AS de FROM x)
SELECT category, {S.rnd('sum(de * de) / nullif(sum(e * e), 0)', 4)} AS durbin_watson FROM d GROUP BY 1""",
)
def _(spark, path):
    keys = ["category"]
    return R.durbin_watson(_seasonal(spark, path, keys), keys)


@query(
    "residual_histogram",
    _pred([]) + f""", b AS (SELECT min(e) AS low, max(e) AS high, (max(e) - min(e)) / 15 AS width FROM x),
n AS (SELECT CAST(unnest(range(15)) AS BIGINT) AS bin),
p AS (SELECT CAST(least(floor((e - low) / width), 14) AS BIGINT) AS bin FROM x, b)
SELECT n.bin, {S.rnd('any_value(low) + n.bin * any_value(width)')} AS bin_start,
       {S.rnd('any_value(low) + (n.bin + 1) * any_value(width)')} AS bin_end, count(p.bin) AS "count"
FROM n CROSS JOIN b LEFT JOIN p ON n.bin = p.bin GROUP BY n.bin""",
)
def _(spark, path):
    return R.residual_histogram(_seasonal(spark, path))


@query(
    "residual_bands",
    _pred(["region"]) + f"""SELECT region, {_DATE}, {S.rnd('e')} AS residual,
       abs(e) <= stddev_pop(e) OVER (PARTITION BY region) AS within_1_sigma,
       abs(e) <= 2 * stddev_pop(e) OVER (PARTITION BY region) AS within_2_sigma FROM x""",
)
def _(spark, path):
    keys = ["region"]
    return R.residual_bands(_seasonal(spark, path, keys), keys)


@query(
    "holdout_table",
    _pred([]) + f"""SELECT {_DATE}, {S.rnd('sales')} AS actual, {S.rnd('prediction')} AS predicted,
       {S.rnd('abs(e)')} AS absolute_error FROM x""",
)
def _(spark, path):
    return holdout_table(_seasonal(spark, path))


@query(
    "baseline_win_count",
    _pred(["category"]) + """SELECT category, count(*) AS weeks,
       count(*) FILTER (abs(sales - sales_lag_1) < abs(e)) AS rival_wins FROM x GROUP BY 1""",
)
def _(spark, path):
    keys = ["category"]
    return E.win_count(_seasonal(spark, path, keys), "sales_lag_1", keys)


@query(
    "forecast_summary",
    _pred(["region"]) + f""", r AS (SELECT region, date, {S.rnd('prediction')} AS p FROM x)
SELECT region, {S.rnd('sum(p)')} AS total_sales, {S.rnd('avg(p)')} AS average_sales,
       max(p) AS peak_sales, CAST(arg_max(date, p) AS VARCHAR) AS peak_date FROM r GROUP BY 1""",
)
def _(spark, path):
    keys = ["region"]
    forecast = _seasonal(spark, path, keys).select(
        *keys, "date", rnd(F.col("prediction"), 2).alias("predicted_sales")
    )
    return forecast_summary(forecast, keys, "date")


def _paired_metrics(spark, path, keys):
    return E.baseline_metrics(_features(spark, path, keys), TEST_YEAR, keys).withColumnsRenamed(
        {m: f"test_{m}" for m in E.METRICS}
    )


_PAIRED = (
    S.split(TEST_YEAR, ["category"])
    + f""", x AS (SELECT * FROM s WHERE role = 'test'), p AS ({S.baselines('x')}),
m AS (SELECT category, model, {S.metrics()} FROM p GROUP BY ALL)
"""
)


@query(
    "best_baseline",
    _PAIRED + f"""SELECT category, arg_min(model, mae) AS best_model, min(mae) AS test_mae,
       {S.rnd("(max(mae) FILTER (model = 'Naive Baseline') - min(mae)) / max(mae) FILTER (model = 'Naive Baseline') * 100")} AS gain_over_naive_pct
FROM m GROUP BY 1""",
)
def _(spark, path):
    keys = ["category"]
    return E.best_model(_paired_metrics(spark, path, keys), "test_mae", keys)


@query(
    "baseline_improvement",
    _PAIRED + f"""SELECT a.category, a.model, b.model AS baseline,
       {S.rnd('(b.mae - a.mae) / nullif(b.mae, 0) * 100')} AS mae_gain,
       {S.rnd('(b.rmse - a.rmse) / nullif(b.rmse, 0) * 100')} AS rmse_gain,
       {S.rnd('b.mape - a.mape')} AS mape_gain, {S.rnd('b.wape - a.wape')} AS wape_gain
FROM m a JOIN m b ON a.category = b.category AND a.model <> b.model""",
)
def _(spark, path):
    keys = ["category"]
    return E.improvement(_paired_metrics(spark, path, keys), keys)

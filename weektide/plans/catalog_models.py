"""Fitted models and forecasts (checked by invariants: SQL cannot fit them)."""

from __future__ import annotations

from pyspark.sql import functions as F

from weektide.functions.numeric import rnd
from weektide.operators import evaluate as E
from weektide.operators import forecast as FC
from weektide.operators import local_models as L
from weektide.operators import models as M
from weektide.operators import residuals as R
from weektide.operators.features import build_features, feature_columns
from weektide.plans import sql as S
from weektide.plans.catalog_evaluation import TEST_YEAR
from weektide.plans.registry import query, series_table
from weektide.sources.durable import durable

def _features(spark, path, keys=()):
    """The feature table, stored before any model reads it many times."""
    return durable(build_features(series_table(spark, path, *keys), list(keys)))


def _train(features):
    return E.chronological_split(features, TEST_YEAR).filter("role = 'train'").drop("role")


def _holdout(name: str):
    def run(spark, path):
        _, seconds, predicted = M.fit_holdout(
            _features(spark, path), TEST_YEAR, {name: M.MODELS[name]}
        )
        return M.holdout_metrics(predicted, seconds).drop("train_seconds")

    return run


for _key, _name in (
    ("ridge_holdout", "Ridge Regression"), ("rf_holdout", "Random Forest"),
    ("hgb_holdout", "HistGradientBoosting"), ("gbt_holdout", "Gradient Boosting"),
):
    query(_key)(_holdout(_name))


@query("holdout_metrics")
def _(spark, path):
    _, seconds, predicted = M.fit_holdout(_features(spark, path), TEST_YEAR)
    return M.holdout_metrics(predicted, seconds)


@query("cv_summary")
def _(spark, path):
    return E.mean_of_folds(M.cross_validate(_train(_features(spark, path)), 5, parallelism=8))


@query("backtest_models")
def _(spark, path):
    return E.backtest_summary(M.backtest(_train(_features(spark, path)), 5, parallelism=8))


@query("model_comparison")
def _(spark, path):
    return M.compare_models(_features(spark, path), TEST_YEAR, parallelism=8)


@query("best_model")
def _(spark, path):
    return E.best_model(M.compare_models(_features(spark, path), TEST_YEAR, parallelism=8))


@query("improvement")
def _(spark, path):
    return E.improvement(M.compare_models(_features(spark, path), TEST_YEAR, parallelism=8))


@query("feature_importance")
def _(spark, path):
    features = _features(spark, path)
    trees = {n: M.MODELS[n] for n in ("Random Forest", "Gradient Boosting")}
    fitted, _, _ = M.fit_holdout(features, TEST_YEAR, trees)
    return M.feature_importance(fitted, feature_columns(features), spark)


def _ridge_predictions(spark, path):
    _, _, predicted = M.fit_holdout(
        _features(spark, path), TEST_YEAR, {"Ridge Regression": M.ridge()}
    )
    return predicted


@query("ridge_holdout_table")
def _(spark, path):
    return FC.holdout_table(_ridge_predictions(spark, path))


@query("ridge_error_rows")
def _(spark, path):
    return R.error_rows(_ridge_predictions(spark, path))


@query("ridge_win_count")
def _(spark, path):
    return E.win_count(_ridge_predictions(spark, path))


@query("forecast")
def _(spark, path):
    features = _features(spark, path)
    return FC.forecast_year(features, FC.train_final_model(features), TEST_YEAR)


@query("recursive_forecast")
def _(spark, path):
    features = _features(spark, path)
    return FC.recursive_forecast(features, FC.train_final_model(features), 12)


@query("recursive_forecast_by_category")
def _(spark, path):
    keys = ["category"]
    features = _features(spark, path, keys)
    models = L.fit_local_ridge(features, keys)
    formula = FC.local_formula(models, keys, feature_columns(features, keys))
    return FC.recursive_forecast(features, formula, 12, keys)


@query("local_ridge_holdout")
def _(spark, path):
    keys = ["category", "sub_category"]
    split = durable(E.chronological_split(
        build_features(series_table(spark, path, *keys), keys), TEST_YEAR
    ))
    train, test = (split.filter(f"role = '{r}'").drop("role") for r in ("train", "test"))
    predicted = L.predict_local(test, L.fit_local_ridge(train, keys), keys)
    return L.local_metrics(predicted, keys)


@query("local_ridge_backtest")
def _(spark, path):
    keys = ["category"]
    return L.backtest_local(_train(_features(spark, path, keys)), keys)


def _described(table, features, predicted):
    """Metadata of the ridge on ``table`` with its measured holdout, verdicts and backtest."""
    named = F.lit("Ridge Regression").alias("model")
    holdout = E.forecast_metrics(predicted).select(named, *E.METRICS)
    tested = E.baseline_metrics(features, TEST_YEAR).unionByName(holdout)
    verdicts = E.comparison_table(tested.withColumnRenamed("mae", "test_mae"))
    measured = holdout.join(
        verdicts.select("model", "beats_naive", "beats_seasonal_naive"), "model"
    ).drop("model")
    folds = M.cross_validate(_train(table), 5, {"Ridge Regression": M.ridge()})
    summary = E.backtest_summary(folds).drop("model")
    out = FC.model_metadata(table, 10.0, measured, summary)
    return out.select("*", "holdout.*", "backtest.*").drop("holdout", "backtest", "features", "created_at")


@query("model_metadata")
def _(spark, path):
    features = _features(spark, path)
    _, _, predicted = M.fit_holdout(features, TEST_YEAR, {"Ridge Regression": M.ridge()})
    return _described(features, features, predicted)


# Models that SQL can say: a recursive mean, and a ridge on two predictors.

_TWO = ["sales_lag_1", "sales_rolling_mean_4"]


@query(
    "recursive_mean_forecast",
    S.features(["category"]).replace("WITH ", "WITH RECURSIVE ", 1) + f""", h AS (
  SELECT category, max(date) AS last, list(sales ORDER BY date DESC)[1:4] AS b FROM f GROUP BY category
), r AS (
  SELECT category, last, 1 AS step, {S.rnd('list_sum(b) / 4.0')} AS p, b FROM h
  UNION ALL
  SELECT category, last, step + 1, {S.rnd('(p + b[1] + b[2] + b[3]) / 4.0')}, [p, b[1], b[2], b[3]]
  FROM r WHERE step < 16
)
SELECT category, CAST(step AS BIGINT) AS horizon_step, CAST(last + CAST(7 * step AS INTEGER) AS VARCHAR) AS forecast_date,
       p AS predicted_sales,
       CASE WHEN step = 1 THEN 'Observed History' ELSE 'Recursive ($h=' || step || '$)' END AS lag_status
FROM r""",
)
def _(spark, path):
    keys = ["category"]
    mean = FC.Formula(lambda columns: columns["sales_rolling_mean_4"])
    features = build_features(series_table(spark, path, *keys), keys)
    return FC.recursive_forecast(features, mean, 16, keys)


def _closed_form(source: str, keys: list[str]) -> str:
    """CTEs ``g`` … ``m``: the closed form of a standardised ridge with penalty 10."""
    head = "".join(f"{k}, " for k in keys)
    group = "GROUP BY ALL" if keys else ""
    x, z = _TWO
    return f"""g AS (
  SELECT {head}count(*) AS n, avg({x}) AS m1, avg({z}) AS m2, avg(sales) AS m,
         stddev_pop({x}) AS s1, stddev_pop({z}) AS s2, covar_pop({x}, {z}) AS c12,
         covar_pop({x}, sales) AS c1, covar_pop({z}, sales) AS c2
  FROM {source} WHERE role = 'train' {group}
), k AS (
  SELECT *, n + 10.0 AS a, n * c12 / (s1 * s2) AS d, n * c1 / s1 AS y1, n * c2 / s2 AS y2 FROM g
), c AS (
  SELECT *, (a * y1 - d * y2) / (a * a - d * d) / s1 AS w1,
         (a * y2 - d * y1) / (a * a - d * d) / s2 AS w2 FROM k
), m AS (SELECT *, m - w1 * m1 - w2 * m2 AS w0 FROM c)
"""


def _ridge_sql(keys: list[str]) -> str:
    """CTEs ``t`` … ``m``: the ridge of each series on the years before the test year."""
    return f"{S.split(TEST_YEAR, keys)}, {_closed_form('s', keys)}"


def _two(spark, path, keys=()):
    return _features(spark, path, keys).select(*keys, "date", "sales", *_TWO)


@query(
    "local_ridge_two",
    _ridge_sql(["category"]) + f"""SELECT category, n, {S.rnd('w0')} AS intercept,
       {S.rnd('w1', 6)} AS weight_1, {S.rnd('w2', 6)} AS weight_2 FROM m""",
)
def _(spark, path):
    keys = ["category"]
    models = L.fit_local_ridge(_train(_two(spark, path, keys)), keys)
    return models.select(
        "category", "n", rnd(F.col("intercept"), 2).alias("intercept"),
        *[rnd(F.get("coefficients", F.lit(k)), 6).alias(f"weight_{k + 1}") for k in (0, 1)],
    )


def _next(sales: list[str]) -> str:
    """The ridge on two predictors, given the last four weeks' sales, newest first."""
    mean = S.rnd(f"({' + '.join(sales)}) / 4.0")
    return f"greatest(w0 + w1 * {sales[0]} + w2 * {mean}, 0.0)"


@query(
    "recursive_ridge_forecast",
    _ridge_sql(["category"]).replace("WITH ", "WITH RECURSIVE ", 1) + f""", h AS (
  SELECT category, max(date) AS last, list(sales ORDER BY date DESC)[1:4] AS b FROM f GROUP BY category
), r AS (
  SELECT h.category, last, 1 AS step, {_next(['b[1]', 'b[2]', 'b[3]', 'b[4]'])} AS p, b
  FROM h JOIN m USING (category)
  UNION ALL
  SELECT r.category, last, step + 1, {_next(['p', 'b[1]', 'b[2]', 'b[3]'])}, [p, b[1], b[2], b[3]]
  FROM r JOIN m USING (category) WHERE step < 16
)
SELECT category, CAST(step AS BIGINT) AS horizon_step, CAST(last + CAST(7 * step AS INTEGER) AS VARCHAR) AS forecast_date,
       {S.rnd('p')} AS predicted_sales,
       CASE WHEN step = 1 THEN 'Observed History' ELSE 'Recursive ($h=' || step || '$)' END AS lag_status
FROM r""",
)
def _(spark, path):
    keys = ["category"]
    features = _features(spark, path, keys)
    models = L.fit_local_ridge(_train(features.select(*keys, "date", "sales", *_TWO)), keys)
    return FC.recursive_forecast(features, FC.local_formula(models, keys, _TWO), 16, keys)


_TWO_PREDICTED = _ridge_sql([]) + f""", x AS (
  SELECT date, sales, w0 + w1 * {_TWO[0]} + w2 * {_TWO[1]} AS prediction
  FROM s, m WHERE role = 'test')
"""


def _two_predicted(spark, path):
    split = durable(E.chronological_split(_two(spark, path), TEST_YEAR))
    fitted = M.fit(split.filter("role = 'train'"), M.ridge(), _TWO)
    return fitted.transform(split.filter("role = 'test'")).select("date", "sales", "prediction")


@query(
    "ridge_two_holdout_table",
    _TWO_PREDICTED + f"""SELECT CAST(date AS VARCHAR) AS date, {S.rnd('sales')} AS actual,
       {S.rnd('prediction')} AS predicted, {S.rnd('abs(sales - prediction)')} AS absolute_error FROM x""",
)
def _(spark, path):
    return FC.holdout_table(_two_predicted(spark, path))


@query("ridge_two_metrics", _TWO_PREDICTED + f"SELECT {S.metrics()} FROM x")
def _(spark, path):
    return E.forecast_metrics(_two_predicted(spark, path))


# Fold 0 stands for the test year: the folds and the holdout are fitted in one go.
@query(
    "model_metadata_two",
    f"""{S.folds(TEST_YEAR)}, every_fold AS (
  SELECT fold, role, sales, {', '.join(_TWO)} FROM cv
  UNION ALL
  SELECT 0, CASE role WHEN 'train' THEN role ELSE 'val' END, sales, {', '.join(_TWO)} FROM s
), {_closed_form('every_fold', ['fold'])}, predicted AS (
  SELECT fold, sales, w0 + w1 * {_TWO[0]} + w2 * {_TWO[1]} AS prediction
  FROM every_fold JOIN m USING (fold) WHERE role = 'val'
), errors AS (SELECT fold, {S.metrics()} FROM predicted GROUP BY fold
), tested AS (SELECT mae, rmse, mape, wape FROM errors WHERE fold = 0
), folded AS (
  SELECT {S.rnd('avg(mae)')} AS mean_mae, {S.rnd('quantile_cont(mae, 0.5)')} AS median_mae,
         {S.rnd('stddev_samp(mae)')} AS std_mae, {S.rnd('avg(rmse)')} AS mean_rmse,
         {S.rnd('avg(mape)')} AS mean_mape, {S.rnd('avg(wape)')} AS mean_wape
  FROM errors WHERE fold > 0
), naive AS (
  SELECT {S.rnd('avg(abs(sales - sales_lag_1))')} AS naive_mae,
         {S.rnd('avg(abs(sales - sales_lag_52))')} AS seasonal_mae FROM s WHERE role = 'test'
), spans AS (SELECT CAST(min(date) AS VARCHAR) AS train_start, CAST(max(date) AS VARCHAR) AS train_end,
                count(*) AS training_rows FROM f)
SELECT spans.*, 'Ridge Regression (standardised, L2)' AS model_name, 'sales' AS target,
       'W-SUN' AS frequency, CAST(1 AS BIGINT) AS forecast_horizon_weeks,
       CAST(10.0 AS DOUBLE) AS alpha, CAST(2 AS BIGINT) AS feature_count, tested.*,
       CASE WHEN mae < naive_mae THEN 'YES' ELSE 'NO' END AS beats_naive,
       CASE WHEN mae < seasonal_mae THEN 'YES' ELSE 'NO' END AS beats_seasonal_naive, folded.*
FROM spans, tested, naive, folded""",
)
def _(spark, path):
    features = _features(spark, path)
    two = features.select("date", "sales", *_TWO)
    split = E.chronological_split(two, TEST_YEAR)
    fitted = M.fit(split.filter("role = 'train'"), M.ridge(), _TWO)
    predicted = fitted.transform(split.filter("role = 'test'"))
    return _described(two, features, predicted.select("date", "sales", "prediction"))

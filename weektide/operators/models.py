"""Pooled regressors on the feature table, fitted by ``pyspark.ml``.

Fits are independent, so folds and models are submitted side by side from a few
driver threads; each fit reads the same reliably stored feature table instead of
recomputing the aggregation behind it.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weektide.functions.numeric import rnd
from weektide.operators.evaluate import (
    METRICS,
    chronological_split,
    comparison_table,
    evaluate_baselines,
    expanding_folds,
    forecast_metrics,
    mean_of_folds,
    require_both_roles,
    with_baselines,
)
from weektide.operators.features import feature_columns
from weektide.sources.durable import durable

#: Builds an estimator from the number and the spread of the training targets.
Factory = Callable[[int, float], Estimator]

_TARGET = {"featuresCol": "features", "labelCol": "sales", "predictionCol": "prediction"}
SEED = 42


def ridge(alpha: float = 10.0) -> Factory:
    """L2 regression on standardised predictors with penalty ``alpha``.

    Spark divides the squared loss by the row count and scales the target by
    its spread; the penalty is restated in those units.
    """

    def build(rows: int, spread: float) -> Estimator:
        return LinearRegression(
            solver="normal", standardization=True, elasticNetParam=0.0,
            regParam=alpha / rows * spread, **_TARGET,
        )

    return build


def random_forest(rows: int, spread: float) -> Estimator:
    return RandomForestRegressor(
        numTrees=100, maxDepth=6, minInstancesPerNode=2, featureSubsetStrategy="all",
        seed=SEED, **_TARGET,
    )


def hist_boosting(rows: int, spread: float) -> Estimator:
    return GBTRegressor(
        maxIter=100, maxDepth=4, stepSize=0.05, minInstancesPerNode=5, maxBins=255,
        seed=SEED, **_TARGET,
    )


def gradient_boosting(rows: int, spread: float) -> Estimator:
    return GBTRegressor(
        maxIter=100, maxDepth=3, stepSize=0.05, minInstancesPerNode=3, seed=SEED, **_TARGET
    )


# The names models are reported under.  The settings above (penalty,
# tree counts, depths, step sizes, leaf sizes, seed) are fixed values too.
MODELS: dict[str, Factory] = {
    "Ridge Regression": ridge(),
    "Random Forest": random_forest,
    "HistGradientBoosting": hist_boosting,
    "Gradient Boosting": gradient_boosting,
}


def _target_scale(train: DataFrame) -> tuple[int, float]:
    row = train.agg(
        F.count("sales").alias("n"), F.stddev_pop(F.col("sales").cast("double")).alias("sd")
    ).first()
    if not row["n"]:
        raise ValueError("no training rows")
    return row["n"], row["sd"]


def fit(train: DataFrame, factory: Factory, columns: list[str]) -> PipelineModel:
    """Assemble ``columns`` and fit one model."""
    rows, spread = _target_scale(train)
    assembler = VectorAssembler(inputCols=columns, outputCol="features")
    return Pipeline(stages=[assembler, factory(rows, spread)]).fit(train)


def _side_by_side(spark: SparkSession, tasks: list[Callable], parallelism: int) -> list:
    if not tasks:
        return []
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        return pool.map(lambda t: inheritable_thread_target(spark)(t)(), tasks)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _predictions(model: PipelineModel, rows: DataFrame, keep: list[str]) -> DataFrame:
    return model.transform(rows).select(*keep, "prediction")


def fit_holdout(
    features: DataFrame,
    test_year: int,
    models: dict[str, Factory] | None = None,
    keys: list[str] | None = None,
    parallelism: int = 4,
) -> tuple[dict[str, PipelineModel], dict[str, float], DataFrame]:
    """Fit on the years before ``test_year``, predict that year.

    Returns the fitted models, the fit seconds and one table of predictions
    ``(keys, date, sales, lag columns, model, prediction)``.
    """
    keys = list(keys or [])
    columns = feature_columns(features, keys)
    split = durable(chronological_split(features, test_year))
    require_both_roles(split)
    train, test = split.filter("role = 'train'"), split.filter("role = 'test'")
    chosen = MODELS if models is None else models

    def task(factory: Factory):
        def run():
            began = time.perf_counter()
            fitted = fit(train, factory, columns)
            return fitted, round(time.perf_counter() - began, 4)

        return run

    spark = features.sparkSession
    results = _side_by_side(spark, [task(f) for f in chosen.values()], parallelism)
    fitted = {name: r[0] for name, r in zip(chosen, results)}
    seconds = {name: r[1] for name, r in zip(chosen, results)}
    keep = [*keys, "date", "sales", "sales_lag_1", "sales_lag_52"]
    predicted = _union(
        [
            _predictions(m, test, keep).withColumn("model", F.lit(name))
            for name, m in fitted.items()
        ]
    )
    return fitted, seconds, predicted


def holdout_metrics(
    predicted: DataFrame, seconds: dict[str, float], keys: list[str] | None = None
) -> DataFrame:
    """Test metrics of every model plus its fit time."""
    spark = predicted.sparkSession
    times = spark.createDataFrame(list(seconds.items()), "model string, train_seconds double")
    return forecast_metrics(predicted, [*(keys or []), "model"]).join(times, "model")


def cross_validate(
    train: DataFrame,
    folds: int = 5,
    models: dict[str, Factory] | None = None,
    keys: list[str] | None = None,
    parallelism: int = 4,
) -> DataFrame:
    """Fold metrics ``(fold, model, mae, rmse, mape, wape)`` of every model.

    All predictions are measured by one grouped aggregate.
    """
    keys = list(keys or [])
    columns = feature_columns(train, keys)
    folded = durable(expanding_folds(train, folds, keys))
    chosen = MODELS if models is None else models

    def task(fold: int, name: str, factory: Factory):
        def run():
            rows = folded.filter(F.col("fold") == fold)
            fitted = fit(rows.filter("role = 'train'"), factory, columns)
            return _predictions(
                fitted, rows.filter("role = 'val'"), [*keys, "date", "sales", "fold"]
            ).withColumn("model", F.lit(name))

        return run

    tasks = [
        task(fold, name, factory)
        for fold in range(1, folds + 1) for name, factory in chosen.items()
    ]
    parts = _side_by_side(train.sparkSession, tasks, parallelism)
    return forecast_metrics(_union(parts), ["fold", "model"])


def backtest(
    train: DataFrame,
    folds: int = 5,
    models: dict[str, Factory] | None = None,
    keys: list[str] | None = None,
    parallelism: int = 4,
) -> DataFrame:
    """Fold metrics of both baselines and every model."""
    val = expanding_folds(train, folds, keys).filter("role = 'val'")
    base = forecast_metrics(with_baselines(val), ["fold", "model"])
    return base.unionByName(cross_validate(train, folds, models, keys, parallelism))


def compare_models(
    features: DataFrame,
    test_year: int,
    folds: int = 5,
    models: dict[str, Factory] | None = None,
    parallelism: int = 4,
) -> DataFrame:
    """Baselines and models side by side: fold means, test metrics, fit time, verdicts."""
    stored = durable(features)
    train = chronological_split(stored, test_year).filter("role = 'train'").drop("role")
    cv = mean_of_folds(cross_validate(train, folds, models, None, parallelism))
    _, seconds, predicted = fit_holdout(stored, test_year, models, None, parallelism)
    test = holdout_metrics(predicted, seconds).withColumnsRenamed(
        {m: f"test_{m}" for m in METRICS}
    )
    base = evaluate_baselines(stored, test_year, folds).withColumn("train_seconds", F.lit(0.0))
    fitted = cv.drop("cv_mae_std", "cv_rmse_std").join(test, "model")
    return comparison_table(base.unionByName(fitted))


def feature_importance(fitted: dict[str, PipelineModel], columns: list[str], spark: SparkSession) -> DataFrame:
    """Importance of each predictor in the tree models and their mean, highest first."""
    sources = {
        "random_forest_importance": "Random Forest",
        "gradient_boosting_importance": "Gradient Boosting",
    }
    present = {c: fitted[m].stages[-1].featureImportances for c, m in sources.items() if m in fitted}
    if not present:
        raise ValueError("no tree model among the fitted models")
    rows = [
        (name, *[float(v[i]) for v in present.values()]) for i, name in enumerate(columns)
    ]
    schema = "feature string, " + ", ".join(f"{c} double" for c in present)
    table = spark.createDataFrame(rows, schema).withColumns(
        {c: rnd(F.col(c), 4) for c in present}
    )
    mean = sum((F.col(c) for c in present), F.lit(0.0)) / len(present)
    return table.withColumn("mean_importance", rnd(mean, 4)).orderBy(
        F.desc("mean_importance"), "feature"
    )

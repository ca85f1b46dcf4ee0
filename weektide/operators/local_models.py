"""One ridge model per series, all series at once.

A group is one series (or one fold of it), at most a few hundred weekly rows, so
the small normal system is solved in a single call per group; series and folds
run in parallel over the cluster.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weektide.operators.evaluate import expanding_folds, forecast_metrics
from weektide.operators.features import feature_columns


def _solve(x: np.ndarray, y: np.ndarray, alpha: float) -> tuple[float, list[float]]:
    """Intercept and coefficients, penalised on standardised predictors."""
    middle, spread = x.mean(axis=0), x.std(axis=0)
    spread = np.where(spread > 0, spread, 1.0)
    z = (x - middle) / spread
    normal = z.T @ z + alpha * np.eye(x.shape[1])
    weights = np.linalg.solve(normal, z.T @ (y - y.mean())) / spread
    return float(y.mean() - weights @ middle), weights.tolist()


def fit_local_ridge(train: DataFrame, keys: list[str], alpha: float = 10.0) -> DataFrame:
    """``(keys, n, intercept, coefficients)``, one row per combination of ``keys``."""
    columns = feature_columns(train, keys)
    types = {f.name: f.dataType.simpleString() for f in train.schema.fields}
    schema = ", ".join(
        [f"`{k}` {types[k]}" for k in keys]
        + ["n bigint", "intercept double", "coefficients array<double>"]
    )

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        intercept, weights = _solve(
            pdf[columns].to_numpy(dtype=float), pdf["sales"].to_numpy(dtype=float), alpha
        )
        head = {k: [pdf[k].iloc[0]] for k in keys}
        return pd.DataFrame(
            head | {"n": [len(pdf)], "intercept": [intercept], "coefficients": [weights]}
        )

    rows = train.select(*keys, *columns, "sales")
    return rows.groupBy(*keys).applyInPandas(solve, schema)


def _dot(columns: list[str]) -> Column:
    products = F.zip_with(
        F.array(*[F.col(c).cast("double") for c in columns]), "coefficients",
        lambda x, w: x * w,
    )
    return F.col("intercept") + F.aggregate(products, F.lit(0.0), lambda s, v: s + v)


def predict_local(
    rows: DataFrame, models: DataFrame, keys: list[str], columns: list[str] | None = None
) -> DataFrame:
    """Add ``prediction`` from the model of each row's series; NULL where it has none."""
    names = columns or feature_columns(rows, keys)
    joined = rows.join(models.drop("n"), keys, "left")
    return joined.withColumn("prediction", _dot(names)).drop("intercept", "coefficients")


def local_metrics(predicted: DataFrame, by: list[str]) -> DataFrame:
    """Metrics per combination of ``by``, and how many of its rows have no prediction."""
    gaps = predicted.groupBy(*by).agg(
        F.count_if(F.col("prediction").isNull()).alias("unpredicted")
    )
    measured = forecast_metrics(predicted.filter("prediction is not null"), by)
    return gaps.join(measured, by, "left")


def backtest_local(
    train: DataFrame, keys: list[str], folds: int = 5, alpha: float = 10.0
) -> DataFrame:
    """Fold metrics of every series' own model."""
    folded = expanding_folds(train, folds, keys)
    columns = feature_columns(train, keys)
    by = [*keys, "fold"]
    models = fit_local_ridge(folded.filter("role = 'train'").drop("role"), by, alpha)
    val = predict_local(folded.filter("role = 'val'").drop("role"), models, by, columns)
    return local_metrics(val, by)

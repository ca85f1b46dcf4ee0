"""Chronological splits, accuracy metrics, baselines and backtests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weektide.functions.numeric import rnd

# Baseline name and the feature that serves as its prediction.
BASELINES = {
    "Naive Baseline": "sales_lag_1",
    "Seasonal Naive Baseline": "sales_lag_52",
}

METRICS = ["mae", "rmse", "mape", "wape"]


def chronological_split(features: DataFrame, test_year: int) -> DataFrame:
    """Add ``role``: years before ``test_year`` train, that year tests, later rows go.

    Every training date is before every test date by construction.
    """
    year = F.year("date")
    role = F.when(year < test_year, "train").when(year == test_year, "test")
    return features.withColumn("role", role).filter(F.col("role").isNotNull())


def require_both_roles(split: DataFrame) -> None:
    """Raise ``ValueError`` when either side of a split is empty (runs a job)."""
    roles = {r["role"] for r in split.select("role").distinct().collect()}
    if roles != {"train", "test"}:
        raise ValueError(f"split has only {sorted(roles)} rows")


def expanding_folds(
    df: DataFrame, folds: int = 5, keys: list[str] | None = None
) -> DataFrame:
    """Rows repeated per fold with ``fold`` and ``role`` (train / val).

    With *n* rows, validation blocks have ``n div (folds + 1)`` rows and end at
    the last row; training takes all rows before its block.
    """
    keys = list(keys or [])
    block = F.expr(f"n_rows div {folds + 1}")
    start = F.col("n_rows") - (F.lit(folds + 1) - F.col("fold")) * block
    role = (
        F.when(F.col("row_no") < start, "train")
        .when(F.col("row_no") < start + block, "val")
    )
    numbered = df.drop("role").withColumns(
        {
            "row_no": F.row_number().over(W.partitionBy(*keys).orderBy("date")) - 1,
            "n_rows": F.count(F.lit(1)).over(W.partitionBy(*keys)),
        }
    )
    return (
        numbered.withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
        .withColumn("role", role).filter(F.col("role").isNotNull())
        .drop("row_no", "n_rows")
    )


def fold_periods(folded: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """First and last day and size of both sides of every fold."""
    sides = []
    for role in ("train", "val"):
        day = F.when(F.col("role") == role, F.col("date"))
        sides += [
            F.min(day).alias(f"{role}_start"), F.max(day).alias(f"{role}_end"),
            F.count(day).alias(f"{role}_n"),
        ]
    return folded.groupBy(*(keys or []), "fold").agg(*sides).withColumn(
        "chronological", F.col("train_end") < F.col("val_start")
    )


def metric_columns(actual: str = "sales", predicted: str = "prediction") -> list[Column]:
    """MAE, RMSE, MAPE over non-zero actuals, and WAPE, rounded to 2 digits."""
    y = F.col(actual).cast("double")
    error = y - F.col(predicted).cast("double")
    ape = F.when(y != 0, F.abs(F.try_divide(error, y)))
    wape = F.try_divide(F.sum(F.abs(error)), F.sum(y)) * 100
    return [
        rnd(F.avg(F.abs(error)), 2).alias("mae"),
        rnd(F.sqrt(F.avg(error * error)), 2).alias("rmse"),
        F.coalesce(rnd(F.avg(ape) * 100, 2), F.lit(0.0)).alias("mape"),
        F.coalesce(rnd(wape, 2), F.lit(0.0)).alias("wape"),
    ]


def forecast_metrics(
    predictions: DataFrame,
    by: list[str] | None = None,
    actual: str = "sales",
    predicted: str = "prediction",
) -> DataFrame:
    return predictions.groupBy(*(by or [])).agg(*metric_columns(actual, predicted))


def with_baselines(features: DataFrame) -> DataFrame:
    """Each row once per baseline, with ``model`` and ``prediction``."""
    pairs = [
        F.struct(F.lit(name).alias("model"), F.col(source).alias("prediction"))
        for name, source in BASELINES.items()
    ]
    return features.withColumn("__b", F.explode(F.array(*pairs))).select(
        *features.columns, "__b.model", "__b.prediction"
    )


def baseline_metrics(
    features: DataFrame, test_year: int, keys: list[str] | None = None
) -> DataFrame:
    """Accuracy of the baselines over the test year."""
    test = chronological_split(features, test_year).filter("role = 'test'")
    return forecast_metrics(with_baselines(test), [*(keys or []), "model"])


def baseline_folds(
    train: DataFrame, folds: int = 5, keys: list[str] | None = None
) -> DataFrame:
    """Accuracy of the baselines per validation block."""
    keys = list(keys or [])
    val = expanding_folds(train, folds, keys).filter("role = 'val'")
    return forecast_metrics(with_baselines(val), [*keys, "fold", "model"])


def mean_of_folds(
    fold_metrics: DataFrame, keys: list[str] | None = None, prefix: str = "cv_"
) -> DataFrame:
    """Per model: plain means of the rounded fold metrics, and population spreads."""
    return fold_metrics.groupBy(*(keys or []), "model").agg(
        *[rnd(F.avg(m), 2).alias(f"{prefix}{m}") for m in METRICS],
        rnd(F.stddev_pop("mae"), 2).alias(f"{prefix}mae_std"),
        rnd(F.stddev_pop("rmse"), 2).alias(f"{prefix}rmse_std"),
    )


def backtest_summary(fold_metrics: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per model: mean, median and sample spread of the fold metrics, best first."""
    return (
        fold_metrics.groupBy(*(keys or []), "model").agg(
            rnd(F.avg("mae"), 2).alias("mean_mae"),
            rnd(F.percentile("mae", 0.5), 2).alias("median_mae"),
            rnd(F.stddev_samp("mae"), 2).alias("std_mae"),
            rnd(F.avg("rmse"), 2).alias("mean_rmse"),
            rnd(F.avg("mape"), 2).alias("mean_mape"),
            rnd(F.avg("wape"), 2).alias("mean_wape"),
        ).orderBy("mean_mae", "model")
    )


def backtest_table(
    folded: DataFrame, fold_metrics: DataFrame, keys: list[str] | None = None
) -> DataFrame:
    """Fold metrics with the periods of both sides written out."""
    keys = list(keys or [])

    def span(side: str) -> Column:
        return F.concat_ws(" to ", F.col(f"{side}_start"), F.col(f"{side}_end"))

    periods = fold_periods(folded, keys).select(
        *keys, "fold", span("train").alias("train_period"), "train_n",
        span("val").alias("val_period"), "val_n",
    )
    return periods.join(fold_metrics, [*keys, "fold"])


def evaluate_baselines(
    features: DataFrame, test_year: int, folds: int = 5, keys: list[str] | None = None
) -> DataFrame:
    """Per baseline: test metrics and fold means over the training years."""
    keys = list(keys or [])
    train = chronological_split(features, test_year).filter("role = 'train'").drop("role")
    cv = mean_of_folds(baseline_folds(train, folds, keys), keys)
    test = baseline_metrics(features, test_year, keys)
    test = test.withColumnsRenamed({m: f"test_{m}" for m in METRICS})
    return cv.drop("cv_mae_std", "cv_rmse_std").join(test, [*keys, "model"])


def comparison_table(
    metrics: DataFrame, keys: list[str] | None = None
) -> DataFrame:
    """Add whether each model beats either baseline on test MAE.

    ``metrics`` holds baselines and models, one row each, with ``test_mae``; the
    baseline value reaches every row through a window over those few rows.
    """
    side = W.partitionBy(*(keys or []))
    is_baseline = F.col("model").isin(*BASELINES)
    out = {}
    for column, name in (("beats_naive", "Naive Baseline"),
                         ("beats_seasonal_naive", "Seasonal Naive Baseline")):
        reference = F.max(F.when(F.col("model") == name, F.col("test_mae"))).over(side)
        out[column] = (
            F.when(is_baseline, "Baseline")
            .when(F.col("test_mae") < reference, "YES").otherwise("NO")
        )
    return metrics.withColumns(out)


def improvement(metrics: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Per model and baseline: relative % gain in MAE and RMSE, points in MAPE and WAPE."""
    side = W.partitionBy(*(keys or []))
    keys = list(keys or [])
    pairs = []
    for name in BASELINES:
        base = {
            m: F.max(F.when(F.col("model") == name, F.col(f"test_{m}"))).over(side)
            for m in METRICS
        }
        gain = {
            m: (F.try_divide(base[m] - F.col(f"test_{m}"), base[m]) * 100)
            if m in ("mae", "rmse") else base[m] - F.col(f"test_{m}")
            for m in METRICS
        }
        pairs.append(
            metrics.select(
                *keys, "model", F.lit(name).alias("baseline"),
                *[rnd(gain[m], 2).alias(f"{m}_gain") for m in METRICS],
            ).filter(F.col("model") != name)
        )
    return pairs[0].unionByName(pairs[1])


def best_model(
    metrics: DataFrame, metric: str = "test_mae", keys: list[str] | None = None
) -> DataFrame:
    """The model with the lowest metric and its gain over the naive baseline in %."""
    naive = F.max(F.when(F.col("model") == "Naive Baseline", F.col(metric)))
    best = F.min(F.struct(F.col(metric), F.col("model")))
    out = metrics.groupBy(*(keys or [])).agg(best.alias("best"), naive.alias("naive"))
    return out.select(
        *(keys or []), F.col("best.model").alias("best_model"),
        F.col(f"best.{metric}").alias(metric),
        rnd(F.try_divide(F.col("naive") - F.col(f"best.{metric}"), F.col("naive")) * 100, 2)
        .alias("gain_over_naive_pct"),
    )


def win_count(
    predictions: DataFrame, rival: str = "sales_lag_52", keys: list[str] | None = None
) -> DataFrame:
    """Weeks in which ``rival`` is closer to the actual than the prediction."""
    rival_error = F.abs(F.col("sales") - F.col(rival))
    error = F.abs(F.col("sales") - F.col("prediction"))
    return predictions.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("weeks"),
        F.count_if(rival_error < error).alias("rival_wins"),
    )

"""End-to-end runs: raw file to cleaned table, features, models and forecasts.

Each stage reads and writes tables, so a stage can be repeated on its own.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from weektide.operators import cleaning, evaluate, forecast, leakage, models, quality, residuals
from weektide.operators.features import build_features, feature_columns
from weektide.schema import DOMAINS
from weektide.session import tune
from weektide.sources import files, sinks
from weektide.sources.durable import durable, stored
from weektide.sources.publish import read_published


def run_cleaning(
    spark: SparkSession,
    raw_path: str,
    out_path: str,
    domains: dict[str, list[str]] | None = DOMAINS,
    strict: bool = True,
    versioned: bool = False,
) -> DataFrame:
    """Raw CSV to cleaned Parquet; ``strict`` raises on broken rules.

    The file is parsed once: rows and unreadable values are counted while the cleaned
    table is written to the shared folder.  The rules are checked there, and only a
    table that keeps them replaces what lies under ``out_path``: in place, or with
    ``versioned`` as the next version, which readers see whole and which writes changed
    years only.  Returns the cleaning summary.
    """
    raw = files.scan_raw_csv(tune(spark), raw_path, typed=False)
    seen = Observation("raw")
    counts = {f"unreadable_{c}": n for c, n in cleaning.unreadable(raw).items()}
    watched = raw.observe(
        seen, F.count(F.lit(1)).alias("rows"), *[n.alias(c) for c, n in counts.items()]
    )
    cleaned = stored(cleaning.clean(watched), "cleaned")
    if strict:
        found = seen.get
        broken = {c: found[c] for c in counts if found[c]}
        if broken:
            raise ValueError(f"data quality: {broken}")
        rules = quality.numeric_bounds(cleaned).unionByName(quality.chronology(cleaned))
        if domains:
            inside = quality.domains(cleaned, domains, exact=False)
            rules = rules.unionByName(
                inside.select(
                    F.concat(F.lit("domain_"), "column").alias("check"),
                    F.col("unexpected").cast("double").alias("value"), "passed",
                )
            )
        quality.enforce(rules)
    write = sinks.publish_cleaned if versioned else sinks.write_cleaned
    write(cleaned, out_path)
    return cleaning.stored_cleaning_summary(raw, seen.get["rows"], cleaned)


def run_features(
    spark: SparkSession,
    cleaned_path: str,
    out_path: str,
    keys: list[str] | None = None,
    versioned: bool = False,
) -> DataFrame:
    """Cleaned table (``versioned``: its current version) to feature table; returns its
    leakage audit."""
    read = partial(read_published, tune(spark)) if versioned else tune(spark).read.parquet
    table = build_features(read(cleaned_path), keys)
    sinks.write_table(table, out_path)
    return leakage.audit(files.load_features(spark, out_path), keys)


def run_training(
    spark: SparkSession,
    features_path: str,
    out_folder: str,
    test_year: int,
    folds: int = 5,
    chosen: dict[str, models.Factory] | None = None,
    parallelism: int = 4,
) -> DataFrame:
    """Baselines, cross-validation, holdout, diagnostics, final model; all stored.

    Returns the comparison table, best test MAE first.
    """
    chosen = chosen or models.MODELS
    features = durable(files.load_features(tune(spark), features_path))
    split = evaluate.chronological_split(features, test_year)
    evaluate.require_both_roles(split)
    train = split.filter("role = 'train'").drop("role")

    baselines = durable(evaluate.evaluate_baselines(features, test_year, folds))
    sinks.write_table(baselines, f"{out_folder}/baselines", "json")
    formula = F.element_at(
        F.create_map(*[F.lit(x) for n, c in evaluate.BASELINES.items() for x in (n, f"prediction = {c}")]),
        F.col("model"),
    )
    sinks.write_table(
        evaluate.with_baselines(split.filter("role = 'test'"))
        .select("model", formula.alias("formula"), "date", "sales", "prediction"),
        f"{out_folder}/baseline_predictions", "json",
    )

    fold_metrics = durable(models.backtest(train, folds, chosen, None, parallelism))
    folded = evaluate.expanding_folds(train, folds)
    sinks.write_table(
        evaluate.backtest_table(folded, fold_metrics), f"{out_folder}/backtest_folds"
    )
    sinks.write_table(
        evaluate.backtest_summary(fold_metrics), f"{out_folder}/backtest_summary"
    )

    fitted, seconds, predicted = models.fit_holdout(
        features, test_year, chosen, None, parallelism
    )
    sinks.save_models(fitted, f"{out_folder}/models")
    predicted = durable(predicted)
    test = models.holdout_metrics(predicted, seconds).withColumnsRenamed(
        {m: f"test_{m}" for m in evaluate.METRICS}
    )
    cv = evaluate.mean_of_folds(fold_metrics.filter(F.col("model").isin(list(chosen))))
    both = cv.drop("cv_mae_std", "cv_rmse_std").join(test, "model")
    comparison = evaluate.comparison_table(
        baselines.withColumn("train_seconds", F.lit(0.0)).unionByName(both)
    )
    sinks.write_table(comparison, f"{out_folder}/model_comparison")

    if {"Random Forest", "Gradient Boosting"} & set(fitted):
        importance = models.feature_importance(fitted, feature_columns(features), spark)
        sinks.write_table(importance, f"{out_folder}/feature_importance", "csv")

    errors = residuals.error_rows(predicted, ["model"])
    sinks.write_table(errors, f"{out_folder}/error_rows")
    sinks.write_table(
        residuals.worst_forecasts(errors, 10, ["model"]), f"{out_folder}/worst_forecasts"
    )

    final = forecast.train_final_model(features)
    sinks.save_models({"final model": final}, f"{out_folder}/models")
    sinks.write_table(
        forecast.forecast_year(features, final, test_year), f"{out_folder}/example_forecast", "csv"
    )
    measured = summary = None
    if "Ridge Regression" in chosen:
        ridge = F.col("model") == "Ridge Regression"
        verdicts = comparison.filter(ridge).select("model", "beats_naive", "beats_seasonal_naive")
        measured = evaluate.forecast_metrics(predicted.filter(ridge), ["model"])
        measured = measured.join(verdicts, "model").drop("model")
        summary = evaluate.backtest_summary(fold_metrics).filter(ridge)
    sinks.write_table(
        forecast.model_metadata(features, 10.0, measured, summary),
        f"{out_folder}/model_metadata", "json",
    )
    return spark.read.parquet(f"{out_folder}/model_comparison").orderBy("test_mae")


def run_forecast(
    spark: SparkSession,
    features_path: str,
    model_path: str,
    out_path: str,
    horizon_weeks: int = 12,
) -> DataFrame:
    """Stored features and model to a CSV of the coming weeks; returns its summary."""
    features = files.load_features(tune(spark), features_path)
    coming = durable(
        forecast.recursive_forecast(features, files.load_model(model_path), horizon_weeks)
    )
    sinks.write_table(coming, out_path, "csv")
    return forecast.forecast_summary(coming)

"""Production model, one-step forecasts and recursive multi-step forecasts."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.regression import LinearRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weektide.functions.dates import calendar_columns
from weektide.functions.numeric import rnd
from weektide.operators.features import DRIVER_LAGS, feature_columns
from weektide.operators.models import fit, ridge
from weektide.schema import LAG_STEPS
from weektide.sources.durable import durable

# Status of the first step and, around its number, of step h.
OBSERVED, RECURSIVE = "Observed History", ("Recursive ($h=", "$)")
#: Status of series that cannot be forecast.
SHORT, NO_MODEL = "Insufficient History", "No Model"
#: Steps after which the state of all series is stored.
STORED_EVERY = 4

#: Adds ``prediction`` to a table of predictors.
Predict = Callable[[DataFrame], DataFrame]


def train_final_model(
    features: DataFrame, alpha: float = 10.0, keys: list[str] | None = None
) -> PipelineModel:
    """Ridge on the whole history."""
    stored = durable(features)
    return fit(stored, ridge(alpha), feature_columns(stored, keys))


def model_metadata(
    features: DataFrame,
    alpha: float,
    holdout: DataFrame | None = None,
    backtest: DataFrame | None = None,
    keys: list[str] | None = None,
) -> DataFrame:
    """One row describing a production model.

    ``holdout`` (test metrics) and ``backtest`` (summary), one row each if given,
    are measured results; nothing is filled in by hand.
    """
    names = feature_columns(features, keys)
    out = features.agg(
        F.min("date").alias("train_start"), F.max("date").alias("train_end"),
        F.count(F.lit(1)).alias("training_rows"),
    ).withColumns(
        {
            "model_name": F.lit("Ridge Regression (standardised, L2)"),
            "target": F.lit("sales"),
            "frequency": F.lit("W-SUN"),
            "forecast_horizon_weeks": F.lit(1),
            "alpha": F.lit(float(alpha)),
            "feature_count": F.lit(len(names)),
            "features": F.array(*[F.lit(n) for n in names]),
            "created_at": F.current_timestamp(),
            "one": F.lit(1),
        }
    )
    for label, table in (("holdout", holdout), ("backtest", backtest)):
        if table is not None:
            row = table.select(F.struct(*table.columns).alias(label), F.lit(1).alias("one"))
            out = out.join(row, "one", "left")
    return out.drop("one")


def model_features(model: PipelineModel) -> list[str]:
    """Predictor names the model was fitted on."""
    return model.stages[0].getInputCols()


def generate_forecast(
    features: DataFrame, model: PipelineModel, keys: list[str] | None = None
) -> DataFrame:
    """One-step forecasts for rows of complete predictors."""
    missing = [c for c in model_features(model) if c not in features.columns]
    if missing:
        raise ValueError(f"forecast input lacks predictors: {missing}")
    return model.transform(features).select(
        *(keys or []), "date", rnd(F.col("prediction"), 2).alias("predicted_sales")
    )


def forecast_year(
    features: DataFrame, model: PipelineModel, year: int, keys: list[str] | None = None
) -> DataFrame:
    """One-step forecasts over a calendar year already in the table."""
    return generate_forecast(features.filter(F.year("date") == year), model, keys)


def holdout_table(predicted: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Actual against predicted sales per week."""
    error = F.abs(F.col("sales") - F.col("prediction"))
    return predicted.select(
        *(keys or []), "date", rnd(F.col("sales"), 2).alias("actual"),
        rnd(F.col("prediction"), 2).alias("predicted"), rnd(error, 2).alias("absolute_error"),
    )


@dataclass(frozen=True)
class Formula:
    """A model as a column expression, so that a whole forecast is one projection.

    ``of`` makes the prediction from the predictors' columns by name.  ``table`` holds
    what it needs of each series' own model (one row per series); a series that is not
    in it has no model.
    """

    of: Callable[[dict[str, Column]], Column]
    table: DataFrame | None = None


def linear_formula(model: PipelineModel) -> Formula:
    """The formula of a linear model: its coefficients are constants."""
    fitted, names = model.stages[-1], model_features(model)
    weights = [float(w) for w in fitted.coefficients]

    def of(columns: dict[str, Column]) -> Column:
        terms = [columns[n].cast("double") * w for n, w in zip(names, weights, strict=True)]
        return sum(terms, F.lit(float(fitted.intercept)))

    return Formula(of)


def local_formula(models: DataFrame, keys: list[str], names: list[str]) -> Formula:
    """The formula of one linear model per series: ``intercept`` and ``coefficients``."""
    def of(columns: dict[str, Column]) -> Column:
        values = F.array(*[columns[n].cast("double") for n in names])
        products = F.zip_with(values, F.col("coefficients"), lambda x, w: x * w)
        return F.col("intercept") + F.aggregate(products, F.lit(0.0), lambda s, v: s + v)

    return Formula(of, models.select(*keys, "intercept", "coefficients"))


def _predictors(back: Column, day: Column) -> dict[str, Column]:
    """Predictors of the week ending on ``day``, from the array ``back`` of the sales
    before it, newest first."""
    lags = {f"sales_lag_{k}": F.get(back, F.lit(k - 1)) for k in LAG_STEPS}
    oldest = f"sales_lag_{max(LAG_STEPS)}"
    lags[oldest] = F.coalesce(lags[oldest], F.get(back, F.lit(0)))

    def mean(width: int) -> Column:
        return F.aggregate(F.slice(back, 1, width), F.lit(0.0), lambda a, v: a + v) / width

    def spread(width: int) -> Column:
        squares = F.aggregate(
            F.transform(F.slice(back, 1, width), lambda v: (v - mean(width)) * (v - mean(width))),
            F.lit(0.0), lambda a, v: a + v,
        )
        return F.sqrt(squares / (width - 1))

    rolling = {
        "mean_4": mean(4), "std_4": spread(4), "min_4": F.array_min(F.slice(back, 1, 4)),
        "max_4": F.array_max(F.slice(back, 1, 4)), "mean_12": mean(12), "std_12": spread(12),
    }
    return calendar_columns(day) | lags | {f"sales_rolling_{n}": rnd(v, 2) for n, v in rolling.items()}


def _at_least_zero(prediction: Column) -> Column:
    return F.when(prediction.isNotNull(), F.greatest(prediction.cast("double"), F.lit(0.0)))


def _folded(formula: Formula, horizon_weeks: int) -> Column:
    """All predictions of a row's series: a fold over the steps of the horizon.

    The fold's state is the array of sales, newest first, the only thing that changes.
    """
    reach = max(LAG_STEPS)
    drivers = {d: F.col(d) for d in DRIVER_LAGS}

    def step(back: Column, number: Column) -> Column:
        day = F.date_add(F.col("last"), (number * 7).cast("int"))
        made = _at_least_zero(formula.of(_predictors(back, day) | drivers))
        return F.concat(F.array(made), back)

    steps = F.sequence(F.lit(1), F.lit(horizon_weeks))
    return F.aggregate(
        steps, F.slice("sales_back", 1, reach), step,
        lambda back: F.reverse(F.slice(back, 1, horizon_weeks)),
    )


def _stepwise(state: DataFrame, predict: Predict, horizon_weeks: int) -> DataFrame:
    """``made``: all predictions of every series, one distributed pass for each step."""
    columns = state.columns
    state = durable(state)
    for number in range(1, horizon_weeks + 1):
        rows = state.withColumn("date", F.date_add("last", 7 * number))
        coming = predict(rows.withColumns(_predictors(F.col("sales_back"), F.col("date"))))
        made = coming.withColumn("made", _at_least_zero(F.col("prediction")))
        state = made.withColumn("sales_back", F.concat(F.array("made"), "sales_back")).select(*columns)
        if number % STORED_EVERY == 0:
            state = durable(state)
    return state.withColumn("made", F.reverse(F.slice("sales_back", 1, horizon_weeks)))


def recursive_forecast(
    features: DataFrame,
    model: PipelineModel | Formula | Predict,
    horizon_weeks: int = 12,
    keys: list[str] | None = None,
) -> DataFrame:
    """Any number of weeks ahead for every series; each step feeds on the steps before.

    The state of a series is one row: its last year of sales as an array, newest
    first, and its driver predictors, which keep the mean of their last four weeks.
    With a linear model or a ``Formula`` all steps are one fold over the horizon inside
    one projection: one job, and a plan that does not grow with the horizon.  Other
    models predict all series in one distributed pass for each step, and lineage is
    cut every few steps.  ``sales_lag_52`` falls back to the last value while a series
    is younger than a year.  A series with fewer than twelve rows, or without a model,
    gets its rows with a status that says so and no prediction.
    """
    if horizon_weeks < 1:
        raise ValueError("horizon_weeks must be at least 1")
    keys = list(keys or [])
    if isinstance(model, PipelineModel):
        linear = isinstance(model.stages[-1], LinearRegressionModel)
        model = linear_formula(model) if linear else model.transform
    reach, drivers = max(LAG_STEPS), list(DRIVER_LAGS)
    newest = W.partitionBy(*keys).orderBy(F.desc("date"))
    recent = (
        features.select(*keys, "date", F.col("sales").cast("double"), *drivers)
        .withColumn("age", F.row_number().over(newest)).filter(F.col("age") <= reach)
    )
    means = [F.avg(F.when(F.col("age") <= 4, F.col(d))).alias(d) for d in drivers]
    by_age = F.array_sort(F.collect_list(F.struct("age", "sales")))
    state = recent.groupBy(*keys).agg(
        F.max("date").alias("last"), F.transform(by_age, lambda x: x["sales"]).alias("sales_back"),
        *means,
    )
    # A table without rows has no series, also where there are no keys.
    state = state.filter(F.col("last").isNotNull())
    short = F.size("sales_back") < 12
    nothing = F.array_repeat(F.lit(None).cast("double"), horizon_weeks)
    problem = F.when(short, SHORT).alias("problem")
    if isinstance(model, Formula):
        if model.table is not None:
            state = state.join(model.table, keys, "left")
        made = F.when(short, nothing).otherwise(_folded(model, horizon_weeks))
        done = state.select(*keys, "last", problem, made.alias("made"))
    else:
        stored = durable(state)
        done = _stepwise(stored.filter(~short), model, horizon_weeks).select(
            *keys, "last", problem, "made"
        ).unionByName(stored.filter(short).select(*keys, "last", problem, nothing.alias("made")))
    step, sales = F.col("pos") + 1, F.col("col")
    status = F.when(step == 1, OBSERVED).otherwise(
        F.concat(F.lit(RECURSIVE[0]), step.cast("string"), F.lit(RECURSIVE[1]))
    )
    status = F.coalesce("problem", F.when(sales.isNull(), NO_MODEL), status)
    return done.select(*keys, "last", "problem", F.posexplode("made")).select(
        *keys, step.cast("int").alias("horizon_step"),
        F.date_add("last", (step * 7).cast("int")).alias("forecast_date"),
        rnd(sales, 2).alias("predicted_sales"), status.alias("lag_status"),
    )


def forecast_summary(
    forecast: DataFrame,
    keys: list[str] | None = None,
    date_col: str = "forecast_date",
) -> DataFrame:
    """Total, mean and peak week of a forecast; of equal peaks the first counts."""
    peak = F.max_by(
        date_col, F.struct(F.col("predicted_sales"), -F.unix_date(date_col))
    )
    return forecast.groupBy(*(keys or [])).agg(
        rnd(F.sum("predicted_sales"), 2).alias("total_sales"),
        rnd(F.avg("predicted_sales"), 2).alias("average_sales"),
        F.max("predicted_sales").alias("peak_sales"),
        peak.alias("peak_date"),
    )

"""Leakage audit of a feature table, per series.

All checks read neighbouring weeks through one window specification and fold
into one aggregate, so a full audit is a single sort and a single pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weektide.functions.numeric import is_close, rnd
from weektide.operators.features import feature_columns
from weektide.operators.resample import series_window
from weektide.schema import SAME_WEEK_COLUMNS

# Correlation limit and the two verdicts.
THRESHOLD = 0.95
CLEAN, LEAKING = "NO TARGET LEAKAGE DETECTED", "TARGET LEAKAGE DETECTED"


def _neighbours(features: DataFrame, keys: list[str]) -> DataFrame:
    w = series_window(keys)
    return features.withColumns(
        {
            "__step": F.datediff("date", F.lag("date").over(w)),
            "__before": F.lag("sales").over(w),
            "__shifted": F.avg("sales").over(w.rowsBetween(-4, -1)),
            "__unshifted": F.avg("sales").over(w.rowsBetween(-3, 0)),
            "__oldest": F.lag("sales", 4).over(w),
            "__ahead": F.lead("sales").over(w),
        }
    )


def _every(condition: Column) -> Column:
    """True when the condition holds on all rows where it is not NULL."""
    return F.coalesce(F.bool_and(condition), F.lit(True))


def _any(condition: Column) -> Column:
    return F.coalesce(F.bool_or(condition), F.lit(False))


def _cadence() -> dict[str, Column]:
    rows = F.count(F.lit(1))
    return {
        "total_rows": rows,
        # A table has no row order of its own: only repeats can break it.
        "duplicate_dates": F.count_if(F.col("__step") == 0),
        "is_monotonic": F.coalesce(F.min("__step") >= 0, F.lit(True)),
        "is_uniform": _every(F.col("__step") == 7),
    }


def _lag() -> dict[str, Column]:
    good = is_close(F.col("sales_lag_1"), F.col("__before"), 1e-2)
    return {"lag_1_aligned": _every(F.when(F.col("__before").isNotNull(), good))}


def _rolling() -> dict[str, Column]:
    stored = F.col("sales_rolling_mean_4")
    full = F.col("__oldest").isNotNull()
    matches = is_close(F.col("__shifted"), stored, 1e-1)
    holds_target = is_close(F.col("__unshifted"), stored, 1e-1) & ~is_close(
        F.col("sales"), F.col("__oldest"), 1e-1
    )
    return {
        "rolling_shifted": _every(F.when(full, matches)),
        "target_in_rolling": _any(F.when(full, holds_target)),
    }


def _future(names: list[str]) -> dict[str, Column]:
    return {c: F.corr(F.col(c).cast("double"), F.col("__ahead")) for c in names}


def _strong(r: Column, threshold: float) -> Column:
    return F.coalesce((F.abs(r) > threshold) & ~F.isnan(r), F.lit(False))


def _check(features: DataFrame, keys: list[str] | None, checks: dict[str, Column]) -> DataFrame:
    keys = list(keys or [])
    return _neighbours(features, keys).groupBy(*keys).agg(
        *[c.alias(n) for n, c in checks.items()]
    )


def cadence(features: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Distinct dates, seven days apart."""
    return _check(features, keys, _cadence())


def lag_alignment(features: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """``sales_lag_1`` equals the sales of the row before."""
    return _check(features, keys, {"compared": F.count("__before")} | _lag())


def rolling_shift(features: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The 4-week mean covers weeks t-4 … t-1 and not t-3 … t."""
    return _check(features, keys, {"compared": F.count("__oldest")} | _rolling())


def future_correlation(
    features: DataFrame, keys: list[str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """Correlation of each predictor with next week's sales, and whether it is too high."""
    keys = list(keys or [])
    names = feature_columns(features, keys)
    long = _check(features, keys, _future(names)).unpivot(keys, names, "feature", "r")
    return long.withColumn("over_threshold", _strong(F.col("r"), threshold)).withColumn(
        "r", rnd(F.col("r"), 4)
    )


def forbidden_columns(features: DataFrame) -> list[str]:
    """Same-week measures left in the table (a look at the schema, no job)."""
    return [c for c in SAME_WEEK_COLUMNS if c in features.columns]


def audit(
    features: DataFrame, keys: list[str] | None = None, threshold: float = THRESHOLD
) -> DataFrame:
    """One row per series: every check and the verdict."""
    keys = list(keys or [])
    names = feature_columns(features, keys)
    forbidden = forbidden_columns(features)
    basic = _cadence() | _lag() | _rolling()
    correlations = {f"__r_{n}": c for n, c in _future(names).items()}
    over = sum(
        (_strong(F.col(r), threshold).cast("int") for r in correlations), F.lit(0)
    )
    passed = (
        F.col("is_monotonic") & F.col("is_uniform") & (F.col("duplicate_dates") == 0)
        & F.col("lag_1_aligned") & F.col("rolling_shifted") & ~F.col("target_in_rolling")
        & (F.col("future_correlations") == 0) & F.lit(not forbidden)
    )
    return (
        _check(features, keys, basic | correlations)
        .select(*keys, *basic, over.alias("future_correlations"))
        .withColumns(
            {
                "forbidden_columns": F.lit(",".join(forbidden)),
                "feature_count": F.lit(len(names)),
                "passed": passed,
                "verdict": F.when(passed, CLEAN).otherwise(LEAKING),
            }
        )
    )

"""Residual diagnostics of forecasts, per series."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weektide.functions.numeric import rnd
from weektide.operators.resample import series_window
from weektide.sources.durable import durable

# Names of the three sales tiers and of the two error directions.
TIER_LOW, TIER_NORMAL, TIER_HIGH = "Low (<25th pct)", "Normal (25th-75th pct)", "High (>75th pct)"
UNDER, OVER = "Underpredicted (Peak Miss)", "Overpredicted (Trough Miss)"


def _residual(actual: str, predicted: str) -> Column:
    """Actual minus predicted: positive means the forecast was too low."""
    return F.col(actual).cast("double") - F.col(predicted).cast("double")


def sales_tiers(
    df: DataFrame, keys: list[str] | None = None, actual: str = "sales"
) -> DataFrame:
    """Add ``q25``, ``q75`` (exact, interpolated) and ``sales_tier`` per series."""
    side = W.partitionBy(*(keys or []))
    y = F.col(actual)
    tier = (
        F.when(y < F.col("q25"), TIER_LOW).when(y > F.col("q75"), TIER_HIGH)
        .otherwise(TIER_NORMAL)
    )
    return df.withColumns(
        {
            "q25": F.percentile(actual, 0.25).over(side),
            "q75": F.percentile(actual, 0.75).over(side),
        }
    ).withColumn("sales_tier", tier)


def error_rows(
    predictions: DataFrame,
    keys: list[str] | None = None,
    actual: str = "sales",
    predicted: str = "prediction",
) -> DataFrame:
    """One row per forecast week; differences are taken before rounding."""
    keys = list(keys or [])
    y, error = F.col(actual).cast("double"), _residual(actual, predicted)
    return sales_tiers(predictions, keys, actual).select(
        *keys, "date",
        rnd(y, 2).alias("actual"),
        rnd(F.col(predicted).cast("double"), 2).alias("predicted"),
        rnd(error, 2).alias("residual"),
        rnd(F.abs(error), 2).alias("absolute_error"),
        rnd(F.try_divide(F.abs(error), y) * 100, 2).alias("ape_pct"),
        F.month("date").alias("month"),
        F.quarter("date").alias("quarter"),
        F.weekofyear("date").alias("week"),
        "sales_tier",
    )


def worst_forecasts(
    errors: DataFrame, n: int = 10, keys: list[str] | None = None
) -> DataFrame:
    """The ``n`` largest absolute errors (of each series) and their direction."""
    direction = F.when(F.col("residual") > 0, UNDER).otherwise(OVER)
    marked = errors.withColumn("error_direction", direction)
    order = [F.desc("absolute_error"), F.asc("date")]
    if not keys:
        return marked.orderBy(*order).limit(n)
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return marked.withColumn("__rank", rank).filter(F.col("__rank") <= n).drop("__rank")


def error_breakdown(errors: DataFrame, by: str, keys: list[str] | None = None) -> DataFrame:
    """Count, means and WAPE of error rows per ``month``, ``quarter`` or ``sales_tier``."""
    return errors.groupBy(*(keys or []), by).agg(
        F.count("actual").alias("count"),
        rnd(F.avg("actual"), 2).alias("mean_actual"),
        rnd(F.avg("predicted"), 2).alias("mean_predicted"),
        rnd(F.avg("absolute_error"), 2).alias("mean_mae"),
        rnd(F.avg("residual"), 2).alias("mean_residual"),
        rnd(F.try_divide(F.sum("absolute_error"), F.sum("actual")) * 100, 2).alias("mean_wape"),
    )


def residual_stats(
    predictions: DataFrame,
    keys: list[str] | None = None,
    actual: str = "sales",
    predicted: str = "prediction",
) -> DataFrame:
    """Mean, population spread and skewness of residuals, t statistic, tier borders."""
    e = _residual(actual, predicted)
    n = F.count(e)
    return predictions.groupBy(*(keys or [])).agg(
        n.alias("n"),
        rnd(F.percentile(actual, 0.25), 2).alias("q25_threshold"),
        rnd(F.percentile(actual, 0.75), 2).alias("q75_threshold"),
        rnd(F.avg(e), 2).alias("mean_residual"),
        rnd(F.stddev_pop(e), 2).alias("std_residual"),
        rnd(F.skewness(e), 3).alias("skewness"),
        rnd(F.try_divide(F.avg(e), F.stddev_samp(e) / F.sqrt(n)), 4).alias("t_test_stat"),
    )


def durbin_watson(
    predictions: DataFrame,
    keys: list[str] | None = None,
    actual: str = "sales",
    predicted: str = "prediction",
) -> DataFrame:
    """Sum of squared residual steps over the sum of squared residuals."""
    stepped = predictions.withColumn("__e", _residual(actual, predicted)).withColumn(
        "__d", F.col("__e") - F.lag("__e").over(series_window(keys))
    )
    ratio = F.try_divide(F.sum(F.col("__d") * F.col("__d")), F.sum(F.col("__e") * F.col("__e")))
    return stepped.groupBy(*(keys or [])).agg(rnd(ratio, 4).alias("durbin_watson"))


def residual_histogram(
    predictions: DataFrame,
    bins: int = 15,
    keys: list[str] | None = None,
    actual: str = "sales",
    predicted: str = "prediction",
) -> DataFrame:
    """Counts in equal bins from the lowest to the highest residual, empty ones too."""
    keys = list(keys or [])
    side = W.partitionBy(*keys)
    e = F.col("__e")
    placed = predictions.withColumn("__e", _residual(actual, predicted)).withColumns(
        {"low": F.min(e).over(side), "high": F.max(e).over(side)}
    )
    width = (F.col("high") - F.col("low")) / bins
    slot = F.coalesce(F.try_divide(e - F.col("low"), width), F.lit(0.0))
    number = F.least(F.floor(slot), F.lit(bins - 1))
    counts = F.array(*[F.count_if(number == i) for i in range(bins)])
    per_series = placed.groupBy(*keys).agg(
        F.min("low").alias("low"), F.max("high").alias("high"), counts.alias("counts")
    )
    listed = per_series.select(*keys, "low", "high", F.posexplode("counts").alias("bin", "count"))
    return listed.select(
        *keys, "bin",
        rnd(F.col("low") + F.col("bin") * width, 2).alias("bin_start"),
        rnd(F.col("low") + (F.col("bin") + 1) * width, 2).alias("bin_end"),
        "count",
    )


def residual_bands(
    predictions: DataFrame,
    keys: list[str] | None = None,
    actual: str = "sales",
    predicted: str = "prediction",
) -> DataFrame:
    """Residual per week and whether it lies within one and two spreads of zero."""
    keys = list(keys or [])
    e = F.col("__e")
    spread = F.stddev_pop(e).over(W.partitionBy(*keys))
    marked = predictions.withColumn("__e", _residual(actual, predicted)).withColumn(
        "__s", spread
    )
    return marked.select(
        *keys, "date", rnd(e, 2).alias("residual"),
        (F.abs(e) <= F.col("__s")).alias("within_1_sigma"),
        (F.abs(e) <= 2 * F.col("__s")).alias("within_2_sigma"),
    )


# Lanczos' coefficients (g = 7, nine terms) for the logarithm of the gamma function.
_LANCZOS = (
    0.99999999999980993, 676.5203681218851, -1259.1392167224028, 771.32342877765313,
    -176.61502916214059, 12.507343278686905, -0.13857109526572012, 9.9843695780195716e-6,
    1.5056327351493116e-7,
)
#: Terms of the continued fraction (exact to 1e-11 up to a million values) and of the error
#: function's series (exact for up to eight spreads).
_FRACTION, _SERIES = 100, 150
#: Degrees of freedom from which Student's t is taken to be normal after Hill's expansion.
_NORMAL_FROM = 1_000_000


def _lgamma(z: Column) -> Column:
    """Logarithm of the gamma function for z >= 0.5."""
    x, series = z - 1, F.lit(_LANCZOS[0])
    for k, c in enumerate(_LANCZOS[1:], 1):
        series = series + F.lit(c) / (x + k)
    t = x + 7.5
    return 0.5 * math.log(2 * math.pi) + (x + 0.5) * F.log(t) - t + F.log(series)


def _beta_fraction(a: Column, b: Column, x: Column) -> Column:
    """The continued fraction of the incomplete beta function, by the modified Lentz method."""
    def some(v: Column) -> Column:
        return F.when(v == 0, F.lit(1e-300)).otherwise(v)

    def coefficient(i: Column) -> Column:
        m = F.floor(i / 2).cast("double")
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        return F.when(i % 2 == 0, even).otherwise(odd)

    def step(s: Column, i: Column) -> Column:
        d = 1 / some(1 + coefficient(i) * s["d"])
        c = some(1 + coefficient(i) / s["c"])
        return F.struct(c.alias("c"), d.alias("d"), (s["f"] * c * d).alias("f"))

    # The first term, 1, is done.
    start = F.struct(F.lit(2.0).alias("c"), F.lit(1.0).alias("d"), F.lit(2.0).alias("f"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(_FRACTION)), start, step, lambda s: s["f"] - 1)


def _beta_share(a: Column, b: Column, x: Column) -> Column:
    """The regularised incomplete beta function where its fraction converges fast."""
    front = F.exp(a * F.log(x) + b * F.log1p(-x) + _lgamma(a + b) - _lgamma(a) - _lgamma(b)) / a
    return front * _beta_fraction(a, b, x)


def upper_normal(z: Column) -> Column:
    """Probability that a standard normal value exceeds ``z``; the error function's series
    of positive terms, exact to 1e-15, beyond eight spreads 0 or 1."""
    x = F.abs(z) / math.sqrt(2)

    def step(s: Column, k: Column) -> Column:
        term = s["term"] * 2 * x * x / (2 * k + 1)
        return F.struct(term.alias("term"), (s["sum"] + term).alias("sum"))

    start = F.struct(x.alias("term"), x.alias("sum"))
    total = F.aggregate(F.sequence(F.lit(1), F.lit(_SERIES)), start, step, lambda s: s["sum"])
    half = F.when(x > 6, F.lit(0.0)).otherwise(
        F.greatest(0.5 - F.exp(-x * x) / math.sqrt(math.pi) * total, F.lit(0.0))
    )
    return F.when(z >= 0, half).otherwise(1 - half)


def student_p(t: Column, n: Column) -> Column:
    """Two-sided p-value of a one-sample t statistic over ``n`` values, as an expression."""
    df = n.cast("double") - 1
    x = df / (df + t * t)
    a, b = df / 2, F.lit(0.5)
    flip = x > (a + 1) / (a + b + 2)
    # Hill's expansion for many degrees of freedom.
    z = F.sqrt(df * F.log1p(t * t / df)) * (1 - 1 / (4 * df))
    exact = F.when(flip, 1 - _beta_share(b, a, 1 - x)).otherwise(_beta_share(a, b, x))
    return (
        F.when((n <= 1) | t.isNull() | F.isnan(t), F.lit(None).cast("double")).when(t == 0, F.lit(1.0))
        .when(F.abs(t) == F.lit(math.inf), F.lit(0.0))
        .when(df > _NORMAL_FROM, 2 * upper_normal(z)).otherwise(exact)
    )


def residual_ttest(
    predictions: DataFrame,
    keys: list[str] | None = None,
    actual: str = "sales",
    predicted: str = "prediction",
) -> DataFrame:
    """Is the mean residual zero?  The p-value is computed on the per-series row."""
    e = _residual(actual, predicted)
    n = F.count(e)
    stats = predictions.groupBy(*(keys or [])).agg(
        n.alias("n"), F.try_divide(F.avg(e), F.stddev_samp(e) / F.sqrt(n)).alias("t")
    )
    return stats.withColumns(
        {"t_test_pval": rnd(student_p(F.col("t"), F.col("n")), 4), "t_test_stat": rnd(F.col("t"), 4)}
    ).drop("t")


# Wichura's rational approximations of the inverse normal (AS 241), for the
# middle, the tails, and the far tails; numerators and denominators from the constant up.
_QUANTILE = {
    "middle": (
        (3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125,
         45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727),
        (1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077, 21213.794301586595867,
         39307.895800092710610, 28729.085735721942674, 5226.4952788528545610),
    ),
    "tail": (
        (1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
         1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 7.74545014278341407640e-4),
        (1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550, 0.148103976427480074590,
         0.0151986665636164571966, 5.47593808499534494600e-4, 1.05075007164441684324e-9),
    ),
    "far": (
        (6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230,
         0.0265321895265761230930, 0.00124266094738807843860, 2.71155556874348757815e-5, 2.01033439929228813265e-7),
        (1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525, 7.86869131145613259100e-4,
         1.84631831751005468180e-5, 1.42151175831644588870e-7, 2.04426310338993978564e-15),
    ),
}
# Royston's polynomials for the outer weights, and for mean and logarithm of
# the spread of log(1 - W), with few values and with many; highest power first.
_LAST, _SECOND = (-2.706056, 4.434685, -2.071190, -0.147981, 0.221157), (-3.582633, 5.682633, -1.752461, -0.293762, 0.042981)
_FEW_MEAN, _FEW_SPREAD = (-0.0006714, 0.025054, -0.39978, 0.5440), (-0.0020322, 0.062767, -0.77857, 1.3822)
_MANY_MEAN, _MANY_SPREAD = (0.0038915, -0.083751, -0.31082, -1.5861), (0.0030302, -0.082676, -0.4803)
#: Values up to which the p-value holds.
_MOST_P = 5000


def polynomial(coefficients, x: Column) -> Column:
    """Horner's scheme, highest power first."""
    out = F.lit(float(coefficients[0]))
    for c in coefficients[1:]:
        out = out * x + c
    return out


def normal_quantile(p: Column) -> Column:
    """The standard normal quantile, exact to about 1e-16."""
    def ratio(part: str, x: Column) -> Column:
        above, below = (polynomial(c[::-1], x) for c in _QUANTILE[part])
        return above / below

    q = p - 0.5
    tail = F.sqrt(-F.log(F.least(p, 1 - p)))
    far = F.when(tail <= 5, ratio("tail", tail - 1.6)).otherwise(ratio("far", tail - 5))
    return F.when(F.abs(q) <= 0.425, q * ratio("middle", 0.180625 - q * q)).otherwise(F.signum(q) * far)


def ranked(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``rows`` with ``__rank`` (from 1) and ``__n`` per series, also where one series has all rows.

    Rows are dealt out by ranges of series and value, so each range has its rows sorted
    alone; what comes before it is told by counts per range.  Equal values are told apart by
    a row number, so many of them do not meet in one task.
    """
    spare = {c: f"__{c}" for c in ("nth", "part", "before")}
    dealt = rows.withColumn(spare["nth"], F.monotonically_increasing_id()).repartitionByRange(
        *keys, value, spare["nth"]
    )
    # Ranges are sampled: stored once, so that counts and ranks see the same ones.
    held = durable(dealt.withColumn(spare["part"], F.spark_partition_id()))
    by = [*keys, spare["part"]]
    counts = held.groupBy(*by).agg(F.count(F.lit(1)).alias("__c"))
    side = W.partitionBy(*keys)
    upto = F.sum("__c").over(side.orderBy(spare["part"]).rowsBetween(W.unboundedPreceding, 0))
    counts = counts.select(
        *[F.col(c).alias(f"__of_{k}") for k, c in enumerate(by)],
        (upto - F.col("__c")).alias(spare["before"]), F.sum("__c").over(side).alias("__n"),
    )
    same = [F.col(c).eqNullSafe(F.col(f"__of_{k}")) for k, c in enumerate(by)]
    place = F.row_number().over(W.partitionBy(*by).orderBy(value, spare["nth"]))
    return (
        held.withColumn("__place", place).join(counts, same)
        .withColumn("__rank", F.col(spare["before"]) + F.col("__place"))
        .select(*rows.columns, "__rank", "__n")
    )


def shapiro_wilk(
    predictions: DataFrame,
    keys: list[str] | None = None,
    actual: str = "sales",
    predicted: str = "prediction",
) -> DataFrame:
    """Normality of residuals: one row per series with ``shapiro_stat`` and ``shapiro_pval``.

    Shapiro and Wilk's W with Royston's weights (1995): sums over ranks, in column
    expressions, so a series may have any number of rows.  ``n`` counts rows, W looks at
    residuals that are not NULL.  Fewer than four of them, or equal ones, give NULL; the
    p-value holds up to 5000 and is NULL beyond.
    """
    keys = list(keys or [])
    rows = predictions.select(*keys, _residual(actual, predicted).alias("__e"))
    value, n, rank = F.col("__e"), F.col("__n"), F.col("__rank")
    clean = ranked(rows.filter(value.isNotNull() & ~F.isnan(value)), keys, "__e")
    score = normal_quantile((rank - 0.375) / (n + 0.25))

    def at(place: Column) -> Column:
        return F.max(F.when(rank == place, value))

    sums = clean.withColumn("__m", score).groupBy(*keys).agg(
        F.max(n).cast("double").alias("__k"), F.sum(F.col("__m") * F.col("__m")).alias("__mm"),
        F.sum(F.when((rank > 1) & (rank < n), F.col("__m") * value)).alias("__inner_1"),
        F.sum(F.when((rank > 2) & (rank < n - 1), F.col("__m") * value)).alias("__inner_2"),
        at(F.lit(1)).alias("__x1"), at(F.lit(2)).alias("__x2"), at(n - 1).alias("__y2"), at(n).alias("__y1"),
        (F.var_pop(value) * F.count(value)).alias("__squares"),
    )
    k, mm, m1, m2, last, second, phi, w, y = (
        F.col(f"__{c}") for c in ("k", "mm", "m1", "m2", "last", "second", "phi", "w", "y")
    )
    u, few, small = 1 / F.sqrt(k), k <= 11, k <= 5
    outer = last * (F.col("__y1") - F.col("__x1"))
    product = F.when(small, outer + F.try_divide(F.col("__inner_1"), F.sqrt(phi))).otherwise(
        outer + second * (F.col("__y2") - F.col("__x2"))
        + F.try_divide(F.coalesce("__inner_2", F.lit(0.0)), F.sqrt(phi))
    )
    mean = F.when(few, polynomial(_FEW_MEAN, k)).otherwise(polynomial(_MANY_MEAN, F.log(k)))
    spread = F.exp(F.when(few, polynomial(_FEW_SPREAD, k)).otherwise(polynomial(_MANY_SPREAD, F.log(k))))
    gamma = 0.459 * k - 2.273
    placed = F.when(few, -F.log(gamma - y)).otherwise(y)
    p = F.when(few & (y >= gamma), F.lit(0.0)).when(k <= _MOST_P, upper_normal((placed - mean) / spread))
    # Step by step, so that no expression holds another one many times over.
    stats = sums
    for more in (
        {f"__m{i + 1}": normal_quantile((k - i - 0.375) / (k + 0.25)) for i in (0, 1)},
        {"__last": polynomial((*_LAST, 0.0), u) + F.try_divide(m1, F.sqrt(mm)),
         "__second": polynomial((*_SECOND, 0.0), u) + F.try_divide(m2, F.sqrt(mm))},
        {"__phi": F.when(small, F.try_divide(mm - 2 * m1 * m1, 1 - 2 * last * last)).otherwise(
            F.try_divide(mm - 2 * m1 * m1 - 2 * m2 * m2, 1 - 2 * last * last - 2 * second * second))},
        {"__w": F.when((k >= 4) & (F.col("__y1") > F.col("__x1")),
                       F.least(F.try_divide(product * product, F.col("__squares")), F.lit(1.0)))},
        {"__y": F.log(F.greatest(1 - w, F.lit(1e-300)))},
    ):
        stats = stats.withColumns(more)
    told = stats.select(
        *[F.col(c).alias(f"__of_{i}") for i, c in enumerate(keys)],
        rnd(w, 4).alias("shapiro_stat"), rnd(F.when(w.isNotNull(), p), 4).alias("shapiro_pval"),
    )
    counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 0")
    same = [F.col(c).eqNullSafe(F.col(f"__of_{i}")) for i, c in enumerate(keys)] or F.lit(True)
    return counted.join(told, same, "left").select(*keys, "n", "shapiro_stat", "shapiro_pval")

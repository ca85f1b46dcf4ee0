"""Distribution profiles of line items: exact quantiles, frequencies, overview."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weektide.functions.numeric import fixed_mean, fixed_sum, rnd
from weektide.operators.quality import cardinalities
from weektide.sources.durable import durable

MEASURES = ["sales", "quantity", "discount", "profit"]

#: Buckets of a doubling of the values in the first pass, and of a bucket's range after it.
_FINE, _SPLIT = 1 << 11, 1 << 12
#: Rows of a bucket that one task may sort.
_SMALL = 1 << 14


def _first_bucket(value: Column) -> Column:
    """A bucket that never falls as ``value`` rises, whatever the range: sign, power of
    two, and place between that power and the next; NaN comes last."""
    size = F.abs(value)
    power = F.least(F.greatest(F.floor(F.log2(size)), F.lit(-1022)), F.lit(1023))
    place = F.least(F.greatest(size / F.pow(F.lit(2.0), power) - 1, F.lit(0.0)), F.lit(1 - 2.0**-30))
    code = (power + 1023) * _FINE + F.floor(place * _FINE) + 1
    return (
        F.when(F.isnan(value), F.lit(2048 * _FINE)).when(value == 0, F.lit(0))
        .when(value < 0, -code).otherwise(code).cast("bigint")
    )


def _unpivoted(df: DataFrame, columns: list[str]) -> DataFrame:
    return (
        df.select(*[F.col(c).cast("double").alias(c) for c in columns])
        .unpivot([], columns, "column", "value")
        .filter(F.col("value").isNotNull())
        .withColumn("bucket", _first_bucket(F.col("value")))
    )


def _holding(buckets: DataFrame, wanted: list[tuple]) -> list[tuple]:
    """The buckets that hold asked ranks.

    ``buckets`` has ``(column, part, bucket, size, low, high)``; ``wanted`` has
    ``(column, part, before, probability, position, rank)``, ``before`` being the number of
    values before the part.  Returns ``wanted`` with the bucket's own number of values before it, and
    its bucket, size, low and high: one for each asked rank.
    """
    spark = buckets.sparkSession
    along = W.partitionBy("column", "part").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
    asked = spark.createDataFrame(
        wanted, "column string, part int, before bigint, probability double, position double, rank bigint"
    )
    upto = F.col("before") + F.col("upto")
    found = (
        buckets.withColumn("upto", F.sum("size").over(along))
        .join(F.broadcast(asked), ["column", "part"])  # two rows for a column and probability
        .filter((F.col("rank") < upto) & (F.col("rank") >= upto - F.col("size")))
        .select("column", "part", (upto - F.col("size")).alias("before"), "probability", "position", "rank",
                "bucket", "size", "low", "high")
    )
    return [tuple(r) for r in found.collect()]


def _selected(values: DataFrame, counted: DataFrame, probabilities: list[float]) -> DataFrame:
    """Quantiles of ``values`` (column, value, bucket), whose buckets ``counted`` has counted."""
    spark = values.sparkSession
    totals = counted.groupBy("column").agg(F.sum("size").alias("total")).collect()
    wanted = [
        (r["column"], 0, 0, float(p), (r["total"] - 1) * float(p), rank)
        for r in totals for p in probabilities
        for rank in sorted({math.floor((r["total"] - 1) * p), math.ceil((r["total"] - 1) * p)})
    ]
    held, buckets = values.withColumn("part", F.lit(0)), counted.withColumn("part", F.lit(0))
    stored = False
    while True:
        hits = _holding(buckets, wanted) if wanted else []
        # Chosen buckets become parts; a column and probability has at most two of them.
        parts: dict[tuple, int] = {}
        for column, part, _, _, _, _, bucket, *_ in hits:
            parts.setdefault((column, part, bucket), len(parts))
        ranges = {parts[h[0], h[1], h[6]]: h[7:] for h in hits}
        chosen = spark.createDataFrame(
            [(*k, n, *map(float, ranges[n][1:])) for k, n in parts.items()],
            "column string, part int, bucket bigint, next int, low double, high double",
        )
        held = (
            held.join(F.broadcast(chosen), ["column", "part", "bucket"])
            .select("column", F.col("next").alias("part"), "value", "low", "high", *(["n"] if stored else []))
        )
        wanted = [(h[0], parts[h[0], h[1], h[6]], *h[2:6]) for h in hits]
        if all(size <= _SMALL or low == high for size, low, high in ranges.values()):
            break
        if not stored:
            # Copies of a value collapse once; further passes read these rows alone.
            held = durable(
                held.groupBy("column", "part", "value", "low", "high").agg(F.count(F.lit(1)).alias("n"))
            )
            stored = True
        place = F.coalesce(
            F.try_divide(F.col("value") - F.col("low"), F.col("high") - F.col("low")), F.lit(0.0)
        )
        held = held.withColumn("bucket", F.least(F.floor(place * _SPLIT), F.lit(_SPLIT - 1)))
        buckets = held.groupBy("column", "part", "bucket").agg(
            F.sum("n").alias("size"), F.min("value").alias("low"), F.max("value").alias("high")
        )
        held = held.drop("low", "high")
    asked = spark.createDataFrame(
        wanted, "column string, part int, before bigint, probability double, position double, rank bigint"
    )
    n = F.sum("n") if stored else F.count(F.lit(1))
    inside = W.partitionBy("column", "part").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    upto = F.col("before") + F.col("seen")
    found = (
        held.groupBy("column", "part", "value").agg(n.alias("n"))
        .withColumn("seen", F.sum("n").over(inside))
        .join(F.broadcast(asked), ["column", "part"])
        .filter((F.col("rank") < upto) & (F.col("rank") >= upto - F.col("n")))
    )
    low, high, part = F.min("value"), F.max("value"), F.max(F.col("position") - F.floor("position"))
    return found.groupBy("column", "probability").agg((low + (high - low) * part).alias("value"))


def exact_quantiles(
    df: DataFrame, columns: list[str], probabilities: list[float]
) -> DataFrame:
    """``(column, probability, value)`` with linear interpolation between ranks.

    The built-in exact percentile keeps every distinct value in one buffer.  Here
    one pass counts values per bucket of a scale that needs no range, which tells the
    buckets that hold the asked ranks, and a second looks at the values of those.  A
    bucket that many values share is split by its own range, and again, until it is
    small enough for one task to sort: each split makes the range ``_SPLIT`` times
    narrower, so three of them reach single values.  Only counts and the chosen
    buckets are ever shuffled, copies of a value collapse first, and what is broadcast
    or collected has two rows per column and probability.
    """
    values = _unpivoted(df, columns)
    counted = durable(values.groupBy("column", "bucket").agg(
        F.count("value").alias("size"), F.min("value").alias("low"), F.max("value").alias("high")
    ))
    return _selected(values, counted, probabilities)


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, spread, exact quartiles, IQR, sum and sign counts per measure.

    The statistics of whole columns and the counts of their buckets come from one pass;
    the quartiles take one more.
    """
    chosen = columns or MEASURES
    values, v = _unpivoted(df, chosen), F.col("value")
    counted = durable(values.groupingSets([["column"], ["column", "bucket"]], "column", "bucket").agg(
        F.grouping("bucket").alias("whole"),
        F.count(v).alias("count"), rnd(fixed_mean(v), 4).alias("mean"), rnd(F.stddev_samp(v), 4).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max"), fixed_sum(v).alias("sum"),
        F.count_if(v < 0).alias("negative"), F.count_if(v == 0).alias("zero"),
    ))
    buckets = counted.filter("whole = 0").select(
        "column", "bucket", F.col("count").alias("size"), F.col("min").alias("low"), F.col("max").alias("high")
    )
    wide = _selected(values, buckets, [0.25, 0.5, 0.75]).groupBy("column").agg(
        *[
            rnd(F.max(F.when(F.col("probability") == p, v)), 4).alias(name)
            for p, name in ((0.25, "q25"), (0.5, "median"), (0.75, "q75"))
        ]
    )
    basic = counted.filter("whole = 1").drop("whole", "bucket")
    # A column of NULLs alone has a row as well; one row per column.
    names = df.sparkSession.createDataFrame([(c,) for c in chosen], "column string")
    return (
        names.join(F.broadcast(basic), "column", "left").join(F.broadcast(wide), "column", "left")
        .fillna(0, ["count", "negative", "zero"])
        .withColumn("iqr", rnd(F.col("q75") - F.col("q25"), 4))
    )


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Frequency and percentage of each member of each column, in one pass."""
    counts = (
        df.select(*columns).unpivot([], columns, "column", "value")
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("frequency"))
    )
    totals = counts.groupBy("column").agg(F.sum("frequency").alias("whole"))
    # One row per column.
    return counts.join(F.broadcast(totals), "column").select(
        "column", "value", "frequency",
        rnd(F.col("frequency") * 100.0 / F.col("whole"), 2).alias("percentage"),
    )


def overview(
    df: DataFrame, columns: list[str], members: DataFrame | None = None
) -> DataFrame:
    """``(metric, value)``: rows, distinct members, first, last and active days.

    ``members`` is the same table projected to ``columns`` and the date; ``df`` then
    needs the date only.
    """
    basic = df.agg(
        F.count(F.lit(1)).cast("string").alias("transactions"),
        F.min("order_date").cast("string").alias("first_order_date"),
        F.max("order_date").cast("string").alias("last_order_date"),
    )
    rows = basic.unpivot(
        [], ["transactions", "first_order_date", "last_order_date"], "metric", "value"
    )
    distinct = cardinalities(df if members is None else members, [*columns, "order_date"]).select(
        F.concat(F.lit("unique_"), "column").alias("metric"),
        F.col("distinct_values").cast("string").alias("value"),
    )
    return rows.unionByName(distinct)

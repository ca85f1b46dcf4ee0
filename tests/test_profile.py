import numpy as np
import pytest
from pyspark.sql import functions as F

from weektide.functions.numeric import fixed_sum, rnd
from weektide.operators import breakdowns, kpis, profile


@pytest.mark.parametrize("kind", ["uniform", "lognormal", "signed", "constant", "copies", "tiny"])
def test_exact_quantiles_equal_numpy(spark, kind):
    rng = np.random.default_rng(7)
    values = {
        "uniform": rng.uniform(0, 1000, 5001),
        "lognormal": rng.lognormal(3, 3, 4000),
        "signed": rng.normal(0, 1e6, 3000),
        "constant": np.full(100, 4.25),
        "copies": np.concatenate([np.full(3000, 9.5), rng.uniform(0, 10, 6000)]),
        "tiny": np.array([1.0, 2.0]),
    }[kind]
    probabilities = [0.0, 0.25, 0.5, 0.75, 0.99, 1.0]
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    got = {
        r["probability"]: r["value"]
        for r in profile.exact_quantiles(df, ["x"], probabilities).collect()
    }
    expected = np.quantile(values, probabilities)
    assert [got[p] for p in probabilities] == pytest.approx(list(expected), rel=1e-12)


def test_fixed_sum_is_exact_in_any_order(spark):
    df = spark.range(100_000).select(
        F.when(F.col("id") % 2 == 0, 0.1).otherwise(-0.0999).alias("x")
    )
    for parts in (1, 7, 16):
        assert df.repartition(parts).agg(fixed_sum(F.col("x"))).first()[0] == 5.0


def test_fixed_sum_beyond_a_machine_word(spark):
    df = spark.range(1000).select(F.lit(8e11).alias("x"))
    assert df.agg(fixed_sum(F.col("x"))).first()[0] == 8e14 * 1.0
    big = spark.range(2_000_000).select(F.lit(8e11).alias("x"))
    assert big.agg(fixed_sum(F.col("x"))).first()[0] == 1.6e18


def test_fixed_sum_loses_no_amount(spark):
    def sum_of(values):
        df = spark.createDataFrame([(v,) for v in values], "x double")
        return df.agg(fixed_sum(F.col("x"))).first()[0]

    assert sum_of([1e15, 1.0]) == 1e15 + 1
    assert sum_of([1e300, 1.0]) == 1e300
    assert abs(sum_of([0.00001] * 10) - 1e-4) < 1e-12
    assert sum_of([0.1 + 0.2, float("nan"), None]) == 0.3


def test_fixed_sum_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert df.agg(fixed_sum(F.col("x"))).first()[0] is None


def test_rounding_is_half_up(spark):
    df = spark.createDataFrame([(1.005,), (0.125,), (-0.125,), (float("nan"),)], "x double")
    got = [r[0] for r in df.select(rnd(F.col("x"), 2)).collect()]
    assert got == [1.01, 0.13, -0.13, None]


def _lines(spark):
    rows = [
        ("o1", "c1", "p1", 100.0, 10.0, 1, 0.0, "A"),
        ("o1", "c1", "p2", 50.0, -20.0, 2, 0.3, "B"),
        ("o2", "c2", "p1", 25.0, 0.0, 3, 0.9, "A"),
        (None, "c2", "p1", 5.0, 1.0, 1, 0.5, None),
    ]
    return spark.createDataFrame(
        rows,
        "order_id string, customer_id string, product_id string, sales double, profit double,"
        " quantity long, discount double, category string",
    )


def test_core_kpis_average_over_orders(spark):
    row = kpis.core_kpis(_lines(spark)).first()
    assert row["total_sales"] == 180.0 and row["num_orders"] == 2
    assert row["average_order_value"] == 87.5  # (150 + 25) / 2: the line without order is out
    assert row["overall_profit_margin_pct"] == -5.0


def test_kpis_of_nothing_are_zero(spark):
    empty = _lines(spark).limit(0)
    row = kpis.core_kpis(empty).first()
    assert row["total_sales"] == 0.0 and row["average_order_value"] == 0.0
    row = kpis.executive_kpis(empty).first()
    assert row["profit_margin"] == 0.0 and row["aov"] == 0.0 and row["total_units"] == 0


def test_null_keys_take_no_part(spark):
    got = {r["category"] for r in breakdowns.category_performance(_lines(spark)).collect()}
    assert got == {"A", "B"}


def test_empty_discount_tiers_show_and_outliers_drop(spark):
    rows = breakdowns.discount_tiers(_lines(spark)).collect()
    assert [r["transactions"] for r in rows] == [1, 0, 1, 1, 0]
    assert [r["profit_margin_pct"] for r in rows] == [10.0, 0.0, -40.0, 20.0, 0.0]


def test_approximate_counts_stay_close(spark):
    df = spark.range(20_000).select(
        F.col("id").alias("order_id"), (F.col("id") % 500).alias("customer_id"),
        (F.col("id") % 70).alias("product_id"), F.lit(1.0).alias("sales"),
        F.lit(1.0).alias("profit"), F.lit(1).cast("long").alias("quantity"),
    )
    exact, near = kpis.core_kpis(df).first(), kpis.core_kpis(df, approximate=0.02).first()
    for name in ("num_orders", "num_customers", "num_products"):
        assert abs(near[name] - exact[name]) <= 0.1 * exact[name]


def test_a_narrow_cluster_is_split_until_it_is_small(spark, monkeypatch):
    """A million values in a sliver of their range beside one outlier."""
    sizes, holding = [], profile._holding

    def spy(buckets, wanted):
        hits = holding(buckets, wanted)
        sizes.append(max(h[7] for h in hits))
        return hits

    monkeypatch.setattr(profile, "_holding", spy)
    n = 1_000_000
    df = spark.range(n).select((1e9 + F.pmod(F.col("id") * 7919, F.lit(n)) * 0.3).alias("x"))
    df = df.union(spark.createDataFrame([(-1.0,)], "x double"))
    got = {r["probability"]: r["value"] for r in profile.exact_quantiles(df, ["x"], [0.0, 0.5, 0.999]).collect()}
    values = np.concatenate([[-1.0], 1e9 + np.arange(n) * 0.3])
    for p, v in got.items():
        assert v == pytest.approx(np.quantile(values, p), rel=1e-12)
    assert len(got) == 3 and sizes[0] > n / 2 and sizes[-1] < 0.05 * n


def test_extreme_values_and_empty_columns(spark):
    inf = float("inf")
    values = [-inf, -1e308, -5e-324, -0.0, 0.0, 5e-324, 2.0**-1022, 1.0, 2.0 - 2**-52, 2.0, 1e308, inf]
    df = spark.createDataFrame([(v, None) for v in values], "x double, y double")
    ranks = [k / (len(values) - 1) for k in range(len(values))]
    got = {r["probability"]: r["value"] for r in profile.exact_quantiles(df, ["x", "y"], [ranks[3], ranks[7], ranks[8]]).collect()}
    assert list(got.values()).count(None) == 0 and sorted(got.values()) == [0.0, 1.0, 2.0 - 2**-52]
    assert profile.exact_quantiles(df.filter("false"), ["x"], [0.5]).collect() == []
    row = profile.describe(df, ["y"]).first()
    assert (row["column"], row["count"], row["sum"], row["median"]) == ("y", 0, None, None)

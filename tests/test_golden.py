"""Published evaluation rows of a 53-week holdout and the numbers published for them."""

import re
from pathlib import Path

import random
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from weektide.operators import evaluate as E
from weektide.operators import residuals as R

ROW = re.compile(r"^\| (\d{4}-\d\d-\d\d) \| ([\d.]+) \| ([\d.]+) \| ([\d.]+) \|$", re.M)


@pytest.fixture(scope="module")
def rows(spark):
    text = (Path(__file__).resolve().parent.parent / "FIXTURES.md").read_text()
    found = [(d, float(a), float(b), float(c)) for d, a, b, c in ROW.findall(text)]
    assert len(found) == 53
    out, before = [], 21384.952
    for d, actual, ridge, seasonal in found:
        out.append((d, actual, ridge, seasonal, before))
        before = actual
    df = spark.createDataFrame(
        out, "d string, sales double, prediction double, sales_lag_52 double, sales_lag_1 double"
    )
    return df.withColumn("date", F.col("d").cast("date")).drop("d").cache()


@pytest.mark.parametrize(
    "column, expected",
    [
        ("prediction", (5377.97, 6778.95, 56.84, 38.58)),
        ("sales_lag_1", (7187.28, 9134.80, 63.05, 51.56)),
        ("sales_lag_52", (7075.47, 9172.35, 61.50, 50.76)),
    ],
)
def test_holdout_metrics(rows, column, expected):
    got = E.forecast_metrics(rows, predicted=column).first()
    assert tuple(got[m] for m in E.METRICS) == expected


def test_residual_statistics(rows):
    got = R.residual_stats(rows).first()
    assert got["mean_residual"] == -1322.05
    assert got["std_residual"] == 6648.79
    assert got["skewness"] == 0.432
    assert (got["q25_threshold"], got["q75_threshold"]) == (7782.87, 19484.32)
    test = R.residual_ttest(rows).first()
    assert (test["t_test_stat"], test["t_test_pval"]) == (-1.4339, 0.1576)
    assert R.durbin_watson(rows).first()["durbin_watson"] == 2.0597
    shape = R.shapiro_wilk(rows).first()
    assert (shape["n"], shape["shapiro_stat"], shape["shapiro_pval"]) == (53, 0.9751, 0.3302)


def test_tiers(rows):
    errors = R.error_rows(rows)
    got = {r["sales_tier"]: r for r in R.error_breakdown(errors, "sales_tier").collect()}
    expected = {
        R.TIER_LOW: (13, 7078.89, -7078.89), R.TIER_NORMAL: (27, 3767.21, -1984.18),
        R.TIER_HIGH: (13, 7022.48, 5809.98),
    }
    assert {k: (v["count"], v["mean_mae"], v["mean_residual"]) for k, v in got.items()} == expected


def test_seasonal_naive_wins_twenty_weeks(rows):
    assert E.win_count(rows).first()["rival_wins"] == 20


def test_worst_forecasts_are_sorted_and_labelled(rows):
    worst = R.worst_forecasts(R.error_rows(rows)).collect()
    sizes = [r["absolute_error"] for r in worst]
    assert len(worst) == 10 and sizes == sorted(sizes, reverse=True)
    assert all((r["residual"] > 0) == (r["error_direction"] == R.UNDER) for r in worst)


def test_metrics_skip_zero_actuals(spark):
    df = spark.createDataFrame(
        [(100.0, 110.0), (200.0, 190.0), (300.0, 330.0), (0.0, 10.0)], "sales double, prediction double"
    )
    got = E.forecast_metrics(df).first()
    assert (got["mae"], got["mape"]) == (15.0, 8.33)
    zeros = spark.createDataFrame([(0.0, 1.0)], "sales double, prediction double")
    got = E.forecast_metrics(zeros).first()
    assert (got["mape"], got["wape"]) == (0.0, 0.0)


def test_histogram_counts_every_row(rows):
    bins = R.residual_histogram(rows).collect()
    assert len(bins) == 15 and sum(b["count"] for b in bins) == 53


def test_student_tail_against_known_values(spark):
    known = [
        (2.0, 10, 0.07338803), (0.5, 3, 0.65144796), (0.0, 5, 1.0), (-2.0, 10, 0.07338803),
        (12.706204736, 1, 0.05), (1.95996398454, 10_000_000, 0.05), (2.0, 200_000, 0.04550144),
    ]
    df = spark.createDataFrame([(t, df + 1, p) for t, df, p in known], "t double, n bigint, p double")
    for r in df.withColumn("got", R.student_p(F.col("t"), F.col("n"))).collect():
        assert r["got"] == pytest.approx(r["p"], abs=1e-8 if r["n"] < 100_000 else 2e-6)
    odd = spark.createDataFrame([(None, 5), (1.0, 1), (float("inf"), 5)], "t double, n bigint")
    got = [r[0] for r in odd.select(R.student_p(F.col("t"), F.col("n"))).collect()]
    assert got == [None, None, 0.0]


def test_p_values_need_no_python(rows):
    for df in (R.residual_ttest(rows), R.shapiro_wilk(rows)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_normal_quantile_and_tail(spark):
    normal = NormalDist()
    p = [1e-14, 1e-6, 0.01, 0.0749, 0.075, 0.3, 0.5, 0.925, 0.99, 1 - 1e-10]
    df = spark.createDataFrame([(x,) for x in p], "p double")
    for r in df.select("p", R.normal_quantile(F.col("p")).alias("z")).collect():
        assert r["z"] == pytest.approx(normal.inv_cdf(r["p"]), rel=1e-9, abs=1e-12)
    z = spark.createDataFrame([(float(x),) for x in (-9, -3, -0.5, 0, 1, 2.5, 6, 9)], "z double")
    for r in z.select("z", R.upper_normal(F.col("z")).alias("p")).collect():
        assert r["p"] == pytest.approx(1 - normal.cdf(r["z"]), abs=1e-14)


def _shapiro(x):
    """W by Royston's weights, plainly."""
    x, n, normal = sorted(x), len(x), NormalDist()
    m = [normal.inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)]
    mm, u = sum(v * v for v in m), n**-0.5
    poly = lambda c: sum(v * u**k for k, v in enumerate(c))
    last = poly([m[-1] / mm**0.5, 0.221157, -0.147981, -2.071190, 4.434685, -2.706056])
    second = poly([m[-2] / mm**0.5, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633])
    if n <= 5:
        phi, ends = (mm - 2 * m[-1] ** 2) / (1 - 2 * last**2), [last]
    else:
        phi = (mm - 2 * m[-1] ** 2 - 2 * m[-2] ** 2) / (1 - 2 * last**2 - 2 * second**2)
        ends = [second, last]
    k = len(ends)
    a = [-v for v in ends[::-1]] + [v / phi**0.5 for v in m[k : n - k]] + ends
    mean = sum(x) / n
    return min(sum(p * q for p, q in zip(a, x, strict=True)) ** 2 / sum((v - mean) ** 2 for v in x), 1.0)


def test_w_of_series_of_all_sizes(spark):
    rng = random.Random(5)
    series = {k: [rng.gauss(0, 3) if k % 2 else rng.expovariate(1) for _ in range(k)] for k in (4, 5, 6, 11, 12, 40, 700)}
    series |= {3: [1.0, 2.0, 4.0], 8: [2.5] * 8, 9: [1.0, 1.0, 1.0, 2.0, 2.0, 5.0, 5.0, 5.0, 7.0]}
    data = [(k, v, 0.0) for k, values in series.items() for v in values] + [(40, None, 0.0), (None, 1.0, 0.0)]
    df = spark.createDataFrame(data, "k int, sales double, prediction double").repartition(5)
    got = {r["k"]: r for r in R.shapiro_wilk(df, ["k"]).collect()}
    assert len(got) == len(series) + 1 and got[40]["n"] == 41
    for k, values in series.items():
        if k in (3, 8):
            assert got[k]["shapiro_stat"] is None and got[k]["shapiro_pval"] is None
        else:
            assert got[k]["shapiro_stat"] == pytest.approx(_shapiro(values), abs=6e-5), k
            assert 0 <= got[k]["shapiro_pval"] <= 1
    assert R.shapiro_wilk(df.filter("false")).collect() == []


def test_w_of_a_million_values_in_one_series(spark):
    """Ranks come from many ranges; a third of the values are equal."""
    n = 1_000_000
    share = (F.pmod(F.col("id") * 7919, F.lit(n)) + 0.5) / n
    value = F.when(F.col("id") % 3 == 0, 0.0).otherwise(R.normal_quantile(share))
    df = spark.range(n).select(value.alias("sales"), F.lit(0.0).alias("prediction"))
    row = R.shapiro_wilk(df).first()
    values = [r[0] for r in df.select("sales").collect()]
    assert row["n"] == n and row["shapiro_pval"] is None
    assert row["shapiro_stat"] == pytest.approx(_shapiro(values), abs=6e-5)
    places = R.ranked(df.limit(20_000), [], "sales").orderBy("__rank").collect()
    assert [r["__rank"] for r in places] == list(range(1, 20_001))
    assert [r["sales"] for r in places] == sorted(r["sales"] for r in places)

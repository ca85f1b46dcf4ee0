import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from weektide.functions.dates import Frequency
from weektide.operators import features as FE
from weektide.operators import leakage, resample
from weektide.plans.registry import series_table

SMALL = "/root/testdata/sf0.001"


def _lines(spark, rows):
    return spark.createDataFrame(
        [(dt.date.fromisoformat(d), o, s, s / 10, 1, 0.1, k) for d, o, s, k in rows],
        "order_date date, order_id string, sales double, profit double, quantity long,"
        " discount double, k string",
    )


def _sorted(df, *by):
    out = df.toPandas().sort_values(list(by)).reset_index(drop=True)
    return out


def test_weeks_end_on_sunday_and_gaps_are_zero(spark):
    df = _lines(spark, [("2020-01-01", "a", 5.0, "x"), ("2020-01-20", "b", 7.0, "x")])
    got = _sorted(resample.aggregate_to_weekly(df), "date")
    assert [str(d) for d in got["date"]] == ["2020-01-05", "2020-01-12", "2020-01-19", "2020-01-26"]
    assert list(got["sales"]) == [5.0, 0.0, 0.0, 7.0]
    assert list(got["avg_discount"]) == [0.1, 0.0, 0.0, 0.1]


@pytest.mark.parametrize("freq", ["D", "W-SUN", "W-WED", "W-SAT", "ME", "QE", "YE"])
def test_resample_equals_pandas(spark, freq):
    table = series_table(spark, SMALL)
    got = _sorted(resample.aggregate_by_time(table, freq), "date")
    pdf = table.toPandas()
    pdf["order_date"] = pd.to_datetime(pdf["order_date"])
    ref = pdf.set_index("order_date").resample(freq).agg(
        {"sales": "sum", "quantity": "sum", "order_id": "nunique"}
    )
    assert [str(d) for d in got["date"]] == [str(d.date()) for d in ref.index]
    np.testing.assert_allclose(got["sales"], ref["sales"], atol=1e-6)
    assert list(got["quantity"]) == list(ref["quantity"])
    assert list(got["orders"]) == list(ref["order_id"])


def test_unknown_frequency():
    with pytest.raises(ValueError):
        Frequency("W-FOO")
    with pytest.raises(ValueError):
        Frequency("H")


def test_partial_weeks_can_be_dropped(spark):
    df = _lines(
        spark,
        [("2020-01-01", "a", 5.0, "x"), ("2020-01-06", "b", 1.0, "x"),
         ("2020-01-20", "b", 1.0, "x"), ("2020-01-28", "c", 7.0, "x")],
    )
    got = _sorted(resample.aggregate_to_weekly(df, drop_partial=True), "date")
    assert [str(d) for d in got["date"]] == ["2020-01-12", "2020-01-19", "2020-01-26"]
    assert list(got["sales"]) == [1.0, 0.0, 1.0]


def _pandas_features(weekly: pd.DataFrame) -> pd.DataFrame:
    f = weekly.sort_values("date").reset_index(drop=True)
    for k in (1, 2, 3, 4, 8, 12, 52):
        f[f"sales_lag_{k}"] = f["sales"].shift(k)
    past = f["sales"].shift(1)
    for width, stats in ((4, ("mean", "std", "min", "max")), (12, ("mean", "std"))):
        for stat in stats:
            f[f"sales_rolling_{stat}_{width}"] = getattr(past.rolling(width), stat)()
    f["orders_lag_1"] = f["orders"].shift(1)
    f["profit_lag_1"] = f["profit"].shift(1)
    return f.dropna().reset_index(drop=True)


def test_features_equal_pandas(spark):
    table = series_table(spark, SMALL)
    got = _sorted(FE.build_features(table), "date")
    ref = _pandas_features(_sorted(resample.aggregate_to_weekly(table), "date"))
    assert len(got) == len(ref) == 293
    for name in ref.columns:
        if name in got.columns and name != "date":
            np.testing.assert_allclose(
                got[name].astype(float), ref[name].astype(float), atol=0.0051, err_msg=name
            )


def test_twenty_six_predictors(spark):
    table = FE.build_features(series_table(spark, SMALL))
    assert len(FE.feature_columns(table)) == 26
    assert not leakage.forbidden_columns(table)


def test_each_series_is_treated_alone(spark):
    table = series_table(spark, SMALL, "region")
    together = FE.build_features(table, ["region"])
    for region in ("ASIA", "EUROPE"):
        alone = FE.build_features(table.filter(F.col("region") == region))
        left = _sorted(together.filter(F.col("region") == region).drop("region"), "date")
        pd.testing.assert_frame_equal(left[alone.columns], _sorted(alone, "date"))


def test_null_dates_and_keys_are_left_out(spark):
    df = _lines(spark, [("2020-01-01", "a", 5.0, "x"), ("2020-01-02", "b", 6.0, None)])
    df = df.unionByName(df.withColumn("order_date", F.lit(None).cast("date")))
    got = resample.aggregate_to_weekly(df, ["k"]).collect()
    assert [(r["k"], r["sales"]) for r in got] == [("x", 5.0)]


def test_audit_passes_and_catches_an_unshifted_window(spark):
    clean = FE.build_features(series_table(spark, SMALL))
    assert leakage.audit(clean).first()["passed"]
    w = resample.series_window([]).rowsBetween(-3, 0)
    leaky = clean.withColumn("sales_rolling_mean_4", F.avg("sales").over(w))
    row = leakage.audit(leaky).first()
    assert row["target_in_rolling"] and not row["rolling_shifted"] and not row["passed"]
    ahead = clean.withColumn("sales_lag_2", F.lead("sales").over(resample.series_window([])))
    assert leakage.audit(ahead).first()["future_correlations"] == 1
    same_week = clean.withColumn("profit", F.col("sales"))
    row = leakage.audit(same_week).first()
    assert row["forbidden_columns"] == "profit" and not row["passed"]


def test_audit_catches_missing_and_repeated_weeks(spark):
    clean = FE.build_features(series_table(spark, SMALL))
    some = clean.orderBy("date").limit(20)
    hole = some.filter(F.col("date") != some.collect()[9]["date"])
    assert not leakage.cadence(hole).first()["is_uniform"]
    twice = some.unionByName(some.limit(1))
    assert leakage.cadence(twice).first()["duplicate_dates"] == 1

import numpy as np
import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Window
from pyspark.sql import functions as F

from weektide.operators import evaluate as E
from weektide.operators import features as FE
from weektide.operators import forecast as FC
from weektide.operators import local_models as L
from weektide.operators import models as M
from weektide.plans.registry import series_table
from weektide.sources import files, sinks
from weektide.sources.durable import checkpoint_dir, durable

SMALL = "/root/testdata/sf0.001"
YEAR = 2001
RIDGE = {"Ridge Regression": M.ridge()}


@pytest.fixture(scope="module")
def features(spark):
    return durable(FE.build_features(series_table(spark, SMALL)))


@pytest.fixture(scope="module")
def by_region(spark):
    return durable(FE.build_features(series_table(spark, SMALL, "region"), ["region"]))


def _closed_form(train, rows, columns, alpha=10.0):
    x, y = train[columns].to_numpy(float), train["sales"].to_numpy(float)
    middle, spread = x.mean(0), x.std(0)
    spread[spread == 0] = 1
    z = (x - middle) / spread
    w = np.linalg.solve(z.T @ z + alpha * np.eye(len(columns)), z.T @ (y - y.mean()))
    return y.mean() + (rows[columns].to_numpy(float) - middle) / spread @ w


def test_checkpoint_folder_is_the_configured_one(spark):
    first = checkpoint_dir(spark)
    assert checkpoint_dir(spark) == first == spark.sparkContext.getCheckpointDir()


def test_split_is_chronological_and_complete(features):
    split = E.chronological_split(features, YEAR).toPandas()
    train, test = split[split.role == "train"], split[split.role == "test"]
    assert (len(train), len(test)) == (262, 31)
    assert train["date"].max() < test["date"].min()
    earlier = E.chronological_split(features, 1999).toPandas()
    assert max(d.year for d in earlier["date"]) == 1999


def test_empty_side_of_a_split_is_refused(features):
    with pytest.raises(ValueError):
        E.require_both_roles(E.chronological_split(features, 1990))


def test_folds_of_104_rows(spark):
    df = spark.range(104).select(F.date_add(F.lit("2015-01-04").cast("date"), (F.col("id") * 7).cast("int")).alias("date"))
    rows = E.fold_periods(E.expanding_folds(df, 5)).orderBy("fold").collect()
    assert [r["train_n"] for r in rows] == [19, 36, 53, 70, 87]
    assert all(r["val_n"] == 17 and r["chronological"] for r in rows)
    assert rows[-1]["val_end"] == df.agg(F.max("date")).first()[0]


def test_folds_of_the_training_years(features):
    train = E.chronological_split(features, YEAR).filter("role = 'train'")
    rows = E.fold_periods(E.expanding_folds(train, 5)).orderBy("fold").collect()
    assert [r["train_n"] for r in rows] == [47, 90, 133, 176, 219]
    assert {r["val_n"] for r in rows} == {43}


def test_ridge_equals_the_closed_form(features):
    columns = FE.feature_columns(features)
    _, _, predicted = M.fit_holdout(features, YEAR, RIDGE)
    got = predicted.orderBy("date").toPandas()["prediction"].to_numpy()
    split = E.chronological_split(features, YEAR).orderBy("date").toPandas()
    train, test = split[split.role == "train"], split[split.role == "test"]
    np.testing.assert_allclose(got, _closed_form(train, test, columns), rtol=1e-7)


def test_local_ridge_equals_the_closed_form(by_region):
    keys, columns = ["region"], FE.feature_columns(by_region, ["region"])
    models = L.fit_local_ridge(by_region, keys)
    got = L.predict_local(by_region, models, keys).toPandas()
    whole = by_region.toPandas()
    for region, rows in whole.groupby("region"):
        rows = rows.sort_values("date")
        mine = got[got.region == region].sort_values("date")["prediction"]
        np.testing.assert_allclose(mine, _closed_form(rows, rows, columns), rtol=1e-7)


def test_local_backtest_has_every_series_and_fold(by_region):
    train = E.chronological_split(by_region, YEAR).filter("role = 'train'").drop("role")
    got = L.backtest_local(train, ["region"])
    assert got.count() == 25 and got.filter("mae is null").count() == 0


def test_backtest_summary_of_baselines_and_models(features):
    train = E.chronological_split(features, YEAR).filter("role = 'train'").drop("role")
    table = M.backtest(train, 5, RIDGE)
    assert table.count() == 15
    summary = E.backtest_summary(table).collect()
    maes = [r["mean_mae"] for r in summary]
    assert len(summary) == 3 and maes == sorted(maes)


def test_comparison_marks_winners(features):
    rows = {r["model"]: r for r in M.compare_models(features, YEAR, 5, RIDGE).collect()}
    assert rows["Naive Baseline"]["beats_naive"] == "Baseline"
    ridge, naive = rows["Ridge Regression"], rows["Naive Baseline"]
    assert (ridge["beats_naive"] == "YES") == (ridge["test_mae"] < naive["test_mae"])


def test_tree_models_and_importance(spark, features):
    small = {
        "Random Forest": lambda n, s: M.random_forest(n, s).setNumTrees(10),
        "Gradient Boosting": lambda n, s: M.gradient_boosting(n, s).setMaxIter(5),
    }
    columns = FE.feature_columns(features)
    fitted, seconds, predicted = M.fit_holdout(features, YEAR, small)
    assert set(seconds) == set(small) and predicted.count() == 62
    table = M.feature_importance(fitted, columns, spark).collect()
    means = [r["mean_importance"] for r in table]
    assert len(table) == 26 and means == sorted(means, reverse=True)
    assert sum(means) == pytest.approx(1.0, abs=0.01)


def test_any_estimator_can_take_part(features):
    plain = {"OLS": lambda n, s: LinearRegression(regParam=0.1, **M._TARGET)}
    _, _, predicted = M.fit_holdout(features, YEAR, plain)
    assert predicted.filter("prediction is null").count() == 0


def test_recursive_forecast(features):
    model = FC.train_final_model(features)
    rows = FC.recursive_forecast(features, model, 4).orderBy("horizon_step").collect()
    last = features.agg(F.max("date")).first()[0]
    assert [(r["forecast_date"] - last).days for r in rows] == [7, 14, 21, 28]
    assert all(r["predicted_sales"] >= 0 for r in rows)
    assert [r["lag_status"] for r in rows][:2] == ["Observed History", "Recursive ($h=2$)"]
    assert FC.recursive_forecast(features, model, 20).filter("predicted_sales >= 0").count() == 20
    with pytest.raises(ValueError):
        FC.recursive_forecast(features, model, 0)


def test_no_series_is_lost(by_region):
    newest = F.row_number().over(Window.partitionBy("region").orderBy(F.desc("date")))
    short = by_region.withColumn("k", newest).filter("region <> 'ASIA' or k <= 9").drop("k")
    models = L.fit_local_ridge(by_region.filter("region <> 'AFRICA'"), ["region"])
    columns = FE.feature_columns(by_region, ["region"])
    rows = FC.recursive_forecast(
        short, lambda d: L.predict_local(d, models, ["region"], columns), 2, ["region"]
    ).collect()
    assert len(rows) == 10
    status = {r["region"]: r["lag_status"] for r in rows if r["horizon_step"] == 2}
    assert status["ASIA"] == FC.SHORT and status["AFRICA"] == FC.NO_MODEL
    lost = {r["region"] for r in rows if r["predicted_sales"] is None}
    assert lost == {"ASIA", "AFRICA"}
    gaps = L.local_metrics(L.predict_local(by_region, models, ["region"]), ["region"]).collect()
    assert {r["region"] for r in gaps if r["unpredicted"]} == {"AFRICA"} and len(gaps) == 5


def test_a_split_needs_both_sides(features):
    with pytest.raises(ValueError, match="split"):
        M.fit_holdout(features, 1900, RIDGE)


def test_serving_uses_the_training_definition(spark):
    """The first step must see what the feature table of the longer history shows."""
    weekly = FE.aggregate_to_weekly(series_table(spark, SMALL))
    full = durable(FE.features_from_weekly(weekly))
    last = full.agg(F.max("date")).first()[0]
    seen = []

    def spy(rows):
        seen.append(rows.toPandas())
        return rows.withColumn("prediction", F.lit(1.0))

    FC.recursive_forecast(full.filter(F.col("date") < last), spy, 1)
    expected = full.filter(F.col("date") == last).toPandas().iloc[0]
    drivers = set(FE.DRIVER_LAGS)
    for name in FE.feature_columns(full):
        if name not in drivers:
            assert seen[0].iloc[0][name] == expected[name], name


def test_many_series_equal_one_series(by_region):
    def mean_of_lags(rows):
        return rows.withColumn("prediction", (F.col("sales_lag_1") + F.col("sales_lag_2")) / 2)

    together = FC.recursive_forecast(by_region, mean_of_lags, 3, ["region"])
    alone = FC.recursive_forecast(
        by_region.filter("region = 'ASIA'").drop("region"), mean_of_lags, 3
    )
    left = together.filter("region = 'ASIA'").drop("region").orderBy("horizon_step").collect()
    assert left == alone.orderBy("horizon_step").collect()
    assert together.count() == 15


def test_a_fold_equals_single_steps(by_region, features):
    """The same model as a formula and as a step of its own."""
    keys = ["region"]
    models = L.fit_local_ridge(by_region.filter("region <> 'AFRICA'"), keys)
    columns = FE.feature_columns(by_region, keys)
    folded = FC.recursive_forecast(by_region, FC.local_formula(models, keys, columns), 9, keys)
    stepped = FC.recursive_forecast(
        by_region, lambda d: L.predict_local(d, models, keys, columns), 9, keys
    )
    order = ["region", "horizon_step"]
    assert folded.orderBy(*order).collect() == stepped.orderBy(*order).collect()
    model = FC.train_final_model(features)
    one = FC.recursive_forecast(features, model, 30).orderBy("horizon_step").toPandas()
    two = FC.recursive_forecast(features, model.transform, 30).orderBy("horizon_step").toPandas()
    assert (one["predicted_sales"] - two["predicted_sales"]).abs().max() <= 0.011
    assert one["lag_status"].equals(two["lag_status"])


def test_the_plan_of_a_fold_does_not_grow(by_region, monkeypatch):
    monkeypatch.setattr(FC, "durable", lambda df: pytest.fail("a fold stores nothing"))
    formula = FC.Formula(lambda c: c["sales_lag_1"] * 1.01)

    def plan(weeks):
        df = FC.recursive_forecast(by_region, formula, weeks, ["region"])
        return df._jdf.queryExecution().analyzed().toString()

    assert abs(len(plan(999)) - len(plan(100))) < 40
    ends = FC.recursive_forecast(by_region, formula, 999, ["region"])
    assert ends.count() == 999 * 5 and ends.filter("predicted_sales is null").count() == 0


def test_nothing_to_forecast(features):
    none = features.filter("false")
    formula = FC.Formula(lambda c: c["sales_lag_1"])
    assert FC.recursive_forecast(none, formula, 3).collect() == []
    assert FC.recursive_forecast(none, lambda d: d.withColumn("prediction", F.lit(1.0)), 3).collect() == []


def test_forecasts_are_clamped_at_zero(features):
    rows = FC.recursive_forecast(features, lambda d: d.withColumn("prediction", F.lit(-5.0)), 2)
    assert {r["predicted_sales"] for r in rows.collect()} == {0.0}


def test_one_step_forecast_checks_its_columns(features, tmp_path):
    model = FC.train_final_model(features)
    with pytest.raises(ValueError, match="sales_lag_8"):
        FC.generate_forecast(features.drop("sales_lag_8"), model)
    before = FC.forecast_year(features, model, 2000)
    paths = sinks.save_models({"final model": model}, str(tmp_path))
    again = FC.forecast_year(features, files.load_model(paths["final model"]), 2000)
    assert before.orderBy("date").collect() == again.orderBy("date").collect()
    assert before.count() == 53


def test_summary_takes_the_first_of_equal_peaks(spark):
    df = spark.createDataFrame(
        [("2020-01-05", 1.0), ("2020-01-12", 9.0), ("2020-01-19", 9.0)], "d string, predicted_sales double"
    ).select(F.col("d").cast("date").alias("forecast_date"), "predicted_sales")
    row = FC.forecast_summary(df).first()
    assert (row["total_sales"], row["peak_sales"], str(row["peak_date"])) == (19.0, 9.0, "2020-01-12")

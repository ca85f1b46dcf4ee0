import datetime as dt

import pytest
from pyspark.sql import functions as F

from weektide.functions import dates, text, tiers
from weektide.operators import cleaning, quality
from weektide.schema import DISCOUNT_EDGES, DOMAINS, canonical_name

D = dt.date


def column(df, name="x"):
    return [r[name] for r in df.collect()]


def test_trim_removes_every_kind_of_white_space(spark):
    raw = ["  Mouse  ", "Keyboard  ", "Normal", "\tTab\n", " nbsp ", "\x1cunit\x1f", None, "a b"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(raw)], "i int, product_name string")
    out = cleaning.trim_text(df).orderBy("i")
    assert column(out, "product_name") == [None if v is None else v.strip() for v in raw]


def test_trim_skips_absent_and_non_text_columns(spark):
    df = spark.createDataFrame([(1, " a ")], "order_id bigint, city string")
    out = cleaning.trim_text(df)
    assert out.dtypes == [("order_id", "bigint"), ("city", "string")]
    assert out.first()["city"] == "a"


def test_postal_code_pads_and_never_cuts(spark):
    df = spark.createDataFrame([("1040",), ("1040.0",), ("123456",), (None,)], "x string")
    out = df.select(text.postal_code(F.col("x")).alias("x"))
    assert column(out) == ["01040", "01040", "123456", None]


def test_mixed_dates_month_first(spark):
    df = spark.createDataFrame(
        [("11/8/2016",), ("06-12-2016",), ("2016-01-05",), ("31/31/2016",), (None,)], "x string"
    )
    out = df.select(dates.parse_mixed_date(F.col("x")).alias("x"))
    assert column(out) == [D(2016, 11, 8), D(2016, 6, 12), D(2016, 1, 5), None, None]


def test_discount_bands_are_right_closed(spark):
    values = [0.0, 0.2, 0.2001, 0.4, 0.8, 0.81, -0.001, -0.0005, 0.6]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, d double")
    out = df.orderBy("i").select(tiers.band_number(F.col("d"), DISCOUNT_EDGES).alias("x"))
    assert column(out) == [1, 2, 3, 3, 5, None, None, 1, 4]


def test_types_turn_unreadable_into_null(spark):
    df = spark.createDataFrame(
        [("1/2/2015", "12.5", "3", "x"), ("bad", "n/a", "4", "0.2")],
        "order_date string, sales string, quantity string, discount string",
    )
    rows = cleaning.standardize_types(df).collect()
    assert rows[0]["order_date"] == D(2015, 1, 2) and rows[0]["sales"] == 12.5
    assert rows[0]["discount"] is None and rows[1]["order_date"] is None
    assert rows[1]["sales"] is None and rows[1]["quantity"] == 4


def test_dedup_keeps_the_lowest_row_and_counts(spark):
    rows = [(3406, "a", 1.0, None), (3407, "a", 1.0, None), (3408, "a", 2.0, None), (1, "b", 1.0, "c")]
    df = spark.createDataFrame(rows, "row_id long, product_name string, profit double, city string")
    out = cleaning.deduplicate(df)
    assert out.columns == df.columns
    assert sorted(column(out, "row_id")) == [1, 3406, 3408]


def test_dedup_runs_after_trim(spark):
    df = spark.createDataFrame([(1, "a ", -1.0), (2, "a", -1.0)], "row_id long, city string, profit double")
    summary = cleaning.cleaning_summary(df).first()
    assert (summary["raw_rows"], summary["cleaned_rows"], summary["rows_removed"]) == (2, 1, 1)
    assert summary["negative_profit_rows_retained"] == 1
    assert column(cleaning.clean(df), "row_id") == [1]


def test_dedup_of_one_huge_group_of_copies(spark):
    df = spark.range(60_000).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k")
    )
    out = cleaning.deduplicate(df)
    assert out.count() == 40_001
    assert out.filter("k = -1").first()["row_id"] == 0


@pytest.mark.parametrize(
    "row, broken",
    [
        ((-5.0, 1, 0.1, 1.0), "sales_non_positive"),
        ((5.0, 0, 0.1, 1.0), "quantity_non_positive"),
        ((5.0, 1, 1.5, 1.0), "discount_out_of_bounds"),
        ((5.0, 1, 0.1, -15.0), None),
    ],
)
def test_numeric_bounds(spark, row, broken):
    df = spark.createDataFrame([row], "sales double, quantity long, discount double, profit double")
    failed = column(quality.numeric_bounds(df).filter("not passed"), "check")
    assert failed == ([broken] if broken else [])


def test_chronology_and_enforce(spark):
    schema = "order_date date, ship_date date"
    good = spark.createDataFrame([(D(2015, 1, 1), D(2015, 1, 3)), (D(2015, 1, 5), D(2015, 1, 5))], schema)
    bad = spark.createDataFrame([(D(2015, 1, 5), D(2015, 1, 1))], schema)
    quality.enforce(quality.chronology(good))
    with pytest.raises(ValueError, match="order_after_ship"):
        quality.enforce(quality.chronology(bad))


def test_domains_exact_and_subset(spark):
    df = spark.createDataFrame([("Furniture", "East"), ("Toys", "West")], "category string, region string")
    exact = {r["column"]: r for r in quality.domains(df, DOMAINS).collect()}
    assert (exact["category"]["unexpected"], exact["category"]["missing"]) == (1, 2)
    assert not exact["region"]["passed"]
    subset = {r["column"]: r["passed"] for r in quality.domains(df, DOMAINS, exact=False).collect()}
    assert subset == {"category": False, "region": True}


def test_duplicates_nest(spark):
    rows = [(1, "o1", "p1"), (1, "o1", "p1"), (2, "o1", "p1"), (3, "o1", "p2"), (4, "o2", "p1")]
    df = spark.createDataFrame(rows, "row_id int, order_id string, product_id string")
    got = {r["check"]: r["value"] for r in quality.duplicates(df).collect()}
    assert got == {
        "full_row_duplicates": 1, "unique_orders": 2, "multi_item_order_rows": 3,
        "duplicate_order_product_pairs": 2,
    }
    members = quality.duplicate_members(df, ["order_id", "product_id"])
    assert sorted(column(members, "row_id")) == [1, 1, 2]


def test_case_variants(spark):
    df = spark.createDataFrame([("Rome",), ("ROME",), ("Oslo",), (None,)], "city string")
    row = quality.case_variants(df, ["city"]).first()
    assert (row["distinct_values"], row["distinct_lower"], row["passed"]) == (3, 2, False)


def test_canonical_names():
    assert canonical_name("Sub-Category") == "sub_category"
    assert canonical_name("Row ID") == "row_id"

import datetime

import pytest
from pyspark.sql import functions as F

from weektide.operators import sketches as SK


@pytest.fixture(scope="module")
def sales(spark):
    """Twelve months, two regions; customers return every month, orders don't."""
    row = F.col("id")
    return spark.range(240_000).select(
        F.expr("add_months(date'2020-01-15', int(id % 12))").alias("order_date"),
        F.when(F.expr("id div 12 % 2 = 0"), "north").otherwise("south").alias("region"),
        row.alias("order_id"),
        (F.hash(row) % 5000).alias("customer_id"),
    )


COLUMNS = ["order_id", "customer_id"]


def close(estimate, exact):
    return abs(estimate - exact) <= max(1, 4 * SK.standard_error() * exact)


def exact(df):
    return df.agg(*[F.countDistinct(c).alias(c) for c in COLUMNS], F.count("*").alias("rows")).first()


def test_spans_of_months(spark, sales):
    months = SK.monthly_sketches(sales, COLUMNS, ["region"]).persist()
    assert months.count() == 24
    for first, last in ((None, None), ("2020-03-20", "2020-07-01"), ("2020-05-31", None), (None, "2020-01-01")):
        got = SK.distinct_from_sketches(
            months, COLUMNS, None,
            *[datetime.date.fromisoformat(d) if d else None for d in (first, last)],
        ).collect()
        within = sales.filter(F.trunc("order_date", "month").between(
            F.trunc(F.lit(first or "1900-01-01"), "month"), F.lit(last or "2100-01-01")))
        want = exact(within)
        assert len(got) == 1 and got[0]["rows"] == want["rows"]
        assert all(close(got[0][c], want[c]) for c in COLUMNS)


def test_by_key(spark, sales):
    months = SK.monthly_sketches(sales, COLUMNS, ["region"])
    for row in SK.distinct_from_sketches(months, COLUMNS, ["region"]).collect():
        want = exact(sales.filter(F.col("region") == row["region"]))
        assert row["rows"] == want["rows"] and all(close(row[c], want[c]) for c in COLUMNS)


def test_later_rows_are_merged(spark, sales):
    early, late = sales.filter("order_id < 150000"), sales.filter("order_id >= 150000")
    merged = SK.merge_sketches(
        SK.monthly_sketches(early, COLUMNS), SK.monthly_sketches(late, COLUMNS), COLUMNS
    )
    got, want = SK.distinct_from_sketches(merged, COLUMNS).first(), exact(sales)
    assert merged.count() == 12 and got["rows"] == want["rows"]
    whole = SK.distinct_from_sketches(SK.monthly_sketches(sales, COLUMNS), COLUMNS).first()
    assert all(close(got[c], want[c]) and close(whole[c], want[c]) for c in COLUMNS)


def test_nulls_and_empty_tables(spark):
    day = datetime.date(2020, 1, 1)
    rows = spark.createDataFrame(
        [(day, 1, None), (day, 1, None), (None, 2, 2), (day, None, None)],
        "order_date date, order_id int, customer_id int",
    )
    got = SK.distinct_from_sketches(SK.monthly_sketches(rows, COLUMNS), COLUMNS).collect()
    assert [tuple(r) for r in got] == [(3, 1, 0)]
    none = SK.monthly_sketches(rows.limit(0), COLUMNS)
    assert [tuple(r) for r in SK.distinct_from_sketches(none, COLUMNS).collect()] == [(0, 0, 0)]

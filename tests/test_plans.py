"""Which tables a query reads, and how often: a join that is not needed costs a shuffle."""

import re
import uuid
from collections import Counter

import pytest

from weektide.operators import profile
from weektide.plans.catalog import QUERIES
from weektide.sources.durable import durable
from weektide.sources.star import colocate, transactions

SMALL = "/root/testdata/sf0.001"

READS = {
    "core_kpis": {"lineitem": 2, "part": 1, "orders": 1},
    "overview": {"lineitem": 2, "orders": 2, "part": 1, "customer": 1, "nation": 1, "region": 1},
    "yoy_growth": {"lineitem": 1, "orders": 1},
    "lag_features": {"lineitem": 1, "orders": 1},
    "rolling_features": {"lineitem": 1, "orders": 1, "customer": 1, "nation": 1, "region": 1},
    "calendar_features": {"lineitem": 1, "orders": 1},
    "active_days": {"lineitem": 1, "orders": 1},
    "dq_dates": {"lineitem": 1, "orders": 1},
    "executive_kpis": {"lineitem": 1, "part": 1},
}


@pytest.mark.parametrize("name", sorted(READS))
def test_tables_read(spark, name):
    df = QUERIES[name](spark, SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    plan += df._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet .*?/(\w+)\.parquet\]", plan)
    assert Counter(scans) == READS[name]


def test_a_description_scans_twice(spark, monkeypatch):
    """One pass for statistics and bucket counts, one for the chosen buckets."""
    plans = []

    def spy(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return durable(df)

    monkeypatch.setattr(profile, "durable", spy)
    df = QUERIES["numeric_describe"](spark, SMALL)
    plans.append(df._jdf.queryExecution().executedPlan().toString())
    # An adaptive plan is told twice: as it stands and as it began.
    assert sum(p.count("lineitem.parquet") > 0 for p in plans) == 2


def test_colocated_orders_leave_the_fact_where_it_is(spark):
    """Without broadcasts, no exchange lies between the fact and its join with the orders."""
    prefix = f"star_{uuid.uuid4().hex[:8]}"
    stored = colocate(spark, SMALL, prefix, 4)
    wanted = ["row_id", "order_date", "customer_id", "quantity"]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        near = transactions(spark, SMALL, wanted, stored)
        far = transactions(spark, SMALL, wanted)

        def plan(df):
            return df._jdf.queryExecution().executedPlan().toString()

        assert "Exchange" in plan(far)
        assert "SortMergeJoin" in plan(near) and "Exchange" not in plan(near)
        assert near.count() == far.count() and near.exceptAll(far).isEmpty()
        # A dimension of the orders moves the orders, not the fact.
        wide = plan(transactions(spark, SMALL, ["row_id", "segment"], stored))
        fact = wide[: wide.index(f"{prefix}_lineitem")].splitlines()
        depth = [len(re.match(r"[\s:+*\-]*", line).group()) for line in fact]
        above = [line for line, d in zip(fact, depth) if d < depth[-1]]
        assert not [line for line in above[-2:] if "Exchange" in line]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        for name in ("lineitem", "orders"):
            spark.sql(f"DROP TABLE {prefix}_{name}")

"""Headline indicators: one row each, one pass over the line items."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weektide.functions.numeric import percent_or_zero, ratio, rnd, total
from weektide.operators.quality import cardinalities

_IDS = {
    "order_id": "num_orders", "customer_id": "num_customers", "product_id": "num_products",
}


def core_kpis(
    df: DataFrame, approximate: float | None = None, ids: DataFrame | None = None
) -> DataFrame:
    """Totals, distinct counts, per-order averages and margin, rounded to cents.

    The mean of the per-order sums equals what rows with an order add up to
    over the number of orders, so no per-order table is built.  The three
    distinct counts share a second, narrow pass: next to the sums, Spark would
    drag all accumulators through the shuffle of the ids.  ``approximate`` (a
    relative error) replaces exact counts by sketches.  ``ids`` is the same table
    projected to the ids: each pass then reads, and joins, only what it uses.
    """
    has_order = F.col("order_id").isNotNull()
    sums = {
        "sales": total(F.col("sales")),
        "profit": total(F.col("profit")),
        "total_quantity": F.coalesce(F.sum("quantity"), F.lit(0)),
        "order_sales": total(F.when(has_order, F.col("sales"))),
        "order_profit": total(F.when(has_order, F.col("profit"))),
    }
    counted = cardinalities(df if ids is None else ids, list(_IDS), approximate).agg(
        *[
            F.max(F.when(F.col("column") == i, F.col("distinct_values"))).alias(n)
            for i, n in _IDS.items()
        ]
    )
    both = df.agg(*[c.alias(n) for n, c in sums.items()]).unionByName(
        counted, allowMissingColumns=True
    )
    base = both.agg(
        *[F.max(n).alias(n) for n in sums],
        *[F.coalesce(F.max(n), F.lit(0)).alias(n) for n in _IDS.values()],
    )
    n = F.col("num_orders")

    def per_order(name: str) -> Column:
        return F.coalesce(rnd(ratio(F.col(name), n), 2), F.lit(0.0))

    return base.select(
        rnd(F.col("sales"), 2).alias("total_sales"),
        rnd(F.col("profit"), 2).alias("total_profit"),
        "total_quantity", *_IDS.values(),
        per_order("order_sales").alias("average_order_value"),
        per_order("order_profit").alias("average_profit_per_order"),
        percent_or_zero(F.col("profit"), F.col("sales")).alias("overall_profit_margin_pct"),
        per_order("total_quantity").alias("average_items_per_order"),
    )


def executive_kpis(df: DataFrame) -> DataFrame:
    """Six unrounded indicators; ratios are 0 where the denominator is 0."""
    base = df.agg(
        total(F.col("sales")).alias("total_sales"),
        total(F.col("profit")).alias("total_profit"),
        F.coalesce(F.sum("quantity"), F.lit(0)).alias("total_units"),
        F.count_distinct("order_id").alias("total_orders"),
        F.count(F.lit(1)).alias("rows"),
    )
    sales, orders = F.col("total_sales"), F.col("total_orders")
    zero = F.lit(0.0)
    return base.select(
        "total_sales", "total_profit",
        F.coalesce(ratio(F.col("total_profit"), sales) * 100, zero).alias("profit_margin"),
        "total_units", "total_orders",
        F.coalesce(ratio(sales, orders), zero).alias("aov"),
        "rows",
    )

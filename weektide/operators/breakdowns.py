"""Performance by dimension.

Sums and counts combine on the map side.  Exact distinct orders per group are
planned by Spark as a first aggregate on (group, order), so a group holding most
of the rows is still spread over all tasks.  Windows run over finished groups
of small dimensions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from weektide.functions.dates import month_name, year_month
from weektide.functions.numeric import (
    fixed_mean,
    fixed_sum,
    percent,
    percent_or_zero,
    ratio,
    rnd,
    total,
)
from weektide.functions.tiers import band_number
from weektide.schema import DISCOUNT_EDGES, DISCOUNT_LABELS


def _measure(name: str) -> Column:
    return {
        "sales": total(F.col("sales")),
        "profit": total(F.col("profit")),
        "quantity": F.coalesce(F.sum("quantity"), F.lit(0)),
        "orders": F.count_distinct("order_id"),
        "transactions": F.count("sales"),
    }[name].alias(name)


def by_dimension(
    df: DataFrame, keys: list[str], measures: list[str], *extra: Column
) -> DataFrame:
    """Named measures per key; rows with a NULL key take no part."""
    for k in keys:
        df = df.filter(F.col(k).isNotNull())
    return df.groupBy(*keys).agg(*[_measure(m) for m in measures], *extra)


def _margin(digits: int = 2) -> Column:
    return percent(F.col("profit"), F.col("sales"), digits)


def _share(column: str, digits: int = 2) -> Column:
    whole = F.sum(column).over(W.partitionBy())
    return percent(F.col(column), whole, digits)


def category_performance(df: DataFrame) -> DataFrame:
    out = by_dimension(
        df, ["category"], ["sales", "profit", "quantity", "orders", "transactions"]
    )
    return out.withColumns(
        {"sales_share_pct": _share("sales"), "profit_margin_pct": _margin()}
    ).orderBy(F.desc("sales"), "category")


def category_contribution(df: DataFrame) -> DataFrame:
    return by_dimension(df, ["category"], ["sales", "profit"]).withColumn(
        "margin_pct", _margin(1)
    )


def subcategory_performance(df: DataFrame) -> DataFrame:
    mean_discount = fixed_mean(F.col("discount"))
    out = by_dimension(
        df, ["category", "sub_category"],
        ["sales", "profit", "quantity", "transactions"],
        rnd(mean_discount, 6).alias("avg_discount"),
        rnd(mean_discount * 100, 2).alias("avg_discount_pct"),
    )
    return out.withColumn("profit_margin_pct", _margin()).orderBy(
        F.desc("profit"), "category", "sub_category"
    )


def regional_performance(df: DataFrame) -> DataFrame:
    out = by_dimension(
        df, ["region"], ["sales", "profit", "quantity", "orders", "transactions"]
    )
    return out.withColumn("profit_margin_pct", _margin()).orderBy(F.desc("sales"), "region")


def segment_performance(df: DataFrame) -> DataFrame:
    out = by_dimension(df, ["segment"], ["sales", "profit", "orders", "quantity"])
    return out.withColumns(
        {
            "profit_margin_pct": _margin(),
            "aov": rnd(ratio(F.col("sales"), F.col("orders")), 2),
        }
    )


def ship_mode_performance(df: DataFrame) -> DataFrame:
    lead = F.datediff("ship_date", "order_date")
    out = by_dimension(
        df, ["ship_mode"], ["transactions", "sales", "profit"],
        rnd(ratio(F.sum(lead), F.count(lead)), 2).alias("mean_lead_days"),
        F.min(lead).alias("min_lead_days"),
        F.max(lead).alias("max_lead_days"),
    )
    return out.withColumn("profit_margin_pct", _margin())


def discount_tiers(
    df: DataFrame,
    edges: list[float] | None = None,
    labels: list[str] | None = None,
) -> DataFrame:
    """Performance per right-closed discount band; empty bands show as 0."""
    edges, labels = edges or DISCOUNT_EDGES, labels or DISCOUNT_LABELS
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per band")
    banded = df.withColumn("tier", band_number(F.col("discount"), edges))
    found = by_dimension(banded, ["tier"], ["transactions", "sales", "profit", "quantity"])
    spine = df.sparkSession.createDataFrame(
        list(enumerate(labels, start=1)), "tier int, discount_tier string"
    )
    out = spine.join(found, "tier", "left").na.fill(0).na.fill(0.0)
    return out.withColumn(
        "profit_margin_pct", percent_or_zero(F.col("profit"), F.col("sales"))
    ).orderBy("tier")


def yearly(df: DataFrame) -> DataFrame:
    """Year totals, margin and growth over the year before; without a margin, and
    without a measure, where the table has no column for it."""
    columns = {"sales": "sales", "profit": "profit", "orders": "order_id", "quantity": "quantity"}
    measures = [m for m, c in columns.items() if c in df.columns]
    out = by_dimension(df.withColumn("year", F.year("order_date")), ["year"], measures)
    before = F.lag("sales").over(W.orderBy("year"))
    added = {"yoy_growth_pct": rnd((ratio(F.col("sales"), before) - 1) * 100, 2)}
    return out.withColumns(({"profit_margin_pct": _margin()} if "profit" in measures else {}) | added)


def overall_growth(df: DataFrame) -> DataFrame:
    """Sales of the last year against the first."""
    years = by_dimension(df.withColumn("year", F.year("order_date")), ["year"], ["sales"])
    first, last = F.min_by("sales", "year"), F.max_by("sales", "year")
    return years.agg(
        F.min("year").alias("first_year"), F.max("year").alias("last_year"),
        rnd((ratio(last, first) - 1) * 100, 2).alias("growth_pct"),
    )


def month_seasonality(df: DataFrame) -> DataFrame:
    """Sales by month of the year over all years."""
    out = by_dimension(
        df.withColumn("month", F.month("order_date")), ["month"], ["sales", "profit"]
    )
    return out.withColumns(
        {"month_name": month_name(F.col("month")), "sales_share_pct": _share("sales")}
    )


def monthly_sales(df: DataFrame) -> DataFrame:
    """Sales per calendar month with sales; months without are not added."""
    return by_dimension(
        df.withColumn("year_month", year_month(F.col("order_date"))), ["year_month"], ["sales"]
    )


def day_of_week(df: DataFrame) -> DataFrame:
    """Share of line items and of sales per weekday (1 = Monday)."""
    out = by_dimension(
        df.withColumn("weekday", F.weekday("order_date") + 1), ["weekday"],
        ["transactions", "sales"],
    )
    return out.withColumns(
        {
            "transaction_share_pct": _share("transactions"),
            "sales_share_pct": _share("sales"),
        }
    )


def month_year_sales(df: DataFrame) -> DataFrame:
    """``(month, year, sales)`` of every month of every year that has rows."""
    return (
        df.filter(F.col("order_date").isNotNull())
        .groupBy(F.month("order_date").alias("month"), F.year("order_date").alias("year"))
        .agg(fixed_sum(F.col("sales")).alias("sales"))
    )


def month_year_pivot(df: DataFrame, years: list[int]) -> DataFrame:
    """The same, one row per month and one sales column per given year; empty cells are
    NULL.  Raises if rows lie in other years."""
    cells = month_year_sales(df)
    other = cells.filter(~F.col("year").isin(years)).select("year").distinct().collect()
    if other:
        raise ValueError(f"rows in years without a column: {sorted(r.year for r in other)}")
    return cells.groupBy("month").agg(*[
        F.max(F.when(F.col("year") == y, F.col("sales"))).alias(f"y{y}") for y in years
    ])


def subcategory_profit(df: DataFrame) -> DataFrame:
    """Profit per sub-category, worst first, with the sign used for colouring."""
    out = by_dimension(df, ["sub_category"], ["profit"])
    sign = F.when(F.col("profit") < 0, "loss").otherwise("profit")
    return out.withColumn("sign", sign).orderBy("profit", "sub_category")


def top_states(df: DataFrame, n: int = 10) -> DataFrame:
    out = by_dimension(df, ["state"], ["orders", "sales", "profit"])
    return out.orderBy(F.desc("sales"), "state").limit(n)


def state_extremes(df: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` states with the highest and with the lowest profit."""
    states = by_dimension(df, ["state"], ["sales", "profit", "orders"]).withColumn(
        "margin_pct", _margin()
    )
    best = states.orderBy(F.desc("profit"), "state").limit(n)
    worst = states.orderBy("profit", "state").limit(n)
    return best.withColumn("side", F.lit("top")).unionByName(
        worst.withColumn("side", F.lit("bottom"))
    )


def best_and_worst(ranked: DataFrame, by: str, tie: str, head: int, tail: int) -> DataFrame:
    """First and last rows of a finished breakdown, as one table."""
    top = ranked.orderBy(F.desc(by), tie).limit(head)
    bottom = ranked.orderBy(F.asc(by), F.desc(tie)).limit(tail)
    return top.withColumn("side", F.lit("top")).unionByName(
        bottom.withColumn("side", F.lit("bottom"))
    )


def top_transactions(df: DataFrame, n: int = 3) -> DataFrame:
    """Line items with the highest sales."""
    wanted = [
        c for c in ("row_id", "order_id", "product_id", "product_name",
                    "sales", "quantity", "profit")
        if c in df.columns
    ]
    ties = [c for c in ("order_id", "product_id", "row_id") if c in wanted]
    return df.select(*wanted).orderBy(F.desc("sales"), *ties).limit(n)


def _top_and_whole(top: DataFrame, rest: DataFrame, measure: str):
    """Two one-row tables ``(top, whole)`` to be united and folded into one row."""
    none = F.lit(None).cast("double")
    return (
        top.agg(F.sum(measure).alias("top"), none.alias("whole")),
        rest.agg(none.alias("top"), F.sum(measure).alias("whole")),
    )


def product_concentration(df: DataFrame, n: int = 50) -> DataFrame:
    """One row: what the ``n`` best-selling products contribute.

    The top list is a distributed take-ordered; product totals never meet in
    one window.
    """
    products = by_dimension(df, ["product_id"], ["sales"])
    top = products.orderBy(F.desc("sales"), "product_id").limit(n)
    top_sales, whole = _top_and_whole(top, products, "sales")
    return top_sales.unionByName(whole).agg(
        F.lit(n).alias("top_n"), rnd(F.max("top"), 2).alias("top_sales"),
        rnd(F.max("whole"), 2).alias("total_sales"),
        percent(F.max("top"), F.max("whole")).alias("share_pct"),
    )


def top_products(df: DataFrame, n: int = 5, worst: int = 3) -> DataFrame:
    """Best sellers and deepest losses by product."""
    products = by_dimension(
        df, ["product_id"], ["sales", "profit", "orders"]
    )
    best = products.orderBy(F.desc("sales"), "product_id").limit(n)
    loss = products.orderBy("profit", "product_id").limit(worst)
    return best.withColumn("list", F.lit("top_sales")).unionByName(
        loss.withColumn("list", F.lit("worst_profit"))
    )


def topk_share(df: DataFrame, dimension: str, k: int) -> DataFrame:
    """Share of sales and of profit held by the ``k`` leading members.

    Both measures are lists of one table, so the rows behind them are read once.
    """
    measures = ["sales", "profit"]
    totals = by_dimension(df, [dimension], measures)
    values = totals.unpivot([dimension], measures, "measure", "value")
    place = F.row_number().over(W.partitionBy("measure").orderBy(F.desc("value"), dimension))
    top = (
        values.withColumn("place", place).filter(F.col("place") <= k)
        .groupBy("measure").agg(F.sum("value").alias("top"))
    )
    whole = values.groupBy("measure").agg(F.sum("value").alias("whole"))
    return top.join(whole, "measure").select(
        F.lit(dimension).alias("dimension"), "measure", F.lit(k).alias("k"),
        percent(F.col("top"), F.col("whole")).alias("share_pct"),
    )


def correlation_matrix(
    df: DataFrame, columns: tuple[str, ...] = ("sales", "quantity", "discount", "profit")
) -> DataFrame:
    """Pearson correlations as ``(column, <one per column>)``, from one aggregate."""
    pairs = {
        (a, b): F.corr(F.col(a).cast("double"), F.col(b).cast("double"))
        for i, a in enumerate(columns) for b in columns[i + 1:]
    }
    one = df.agg(*[rnd(c, 6).alias(f"{a}~{b}") for (a, b), c in pairs.items()])

    def cell(a: str, b: str) -> Column:
        if a == b:
            return F.lit(1.0)
        return F.col(f"`{a}~{b}`" if (a, b) in pairs else f"`{b}~{a}`")

    lines = [
        F.struct(F.lit(a).alias("column"), *[cell(a, b).alias(b) for b in columns])
        for a in columns
    ]
    return one.select(F.inline(F.array(*lines)))


def discount_by_profit_sign(df: DataFrame) -> DataFrame:
    """Loss-making rows, their share, and the mean discount on either side of zero."""
    loss = F.col("profit") < 0
    gain = F.col("profit") >= 0

    def mean_discount(side: Column) -> Column:
        kept = F.when(side, F.col("discount"))
        return rnd(fixed_mean(kept) * 100, 2)

    return df.agg(
        F.count_if(loss).alias("loss_rows"),
        percent(F.count_if(loss), F.count(F.lit(1))).alias("loss_pct"),
        mean_discount(loss).alias("loss_discount_pct"),
        mean_discount(gain).alias("gain_discount_pct"),
    )


def profit_classes(df: DataFrame) -> DataFrame:
    """Rows, share and sum of profitable, break-even and loss-making line items."""
    kind = (
        F.when(F.col("profit") > 0, "profit").when(F.col("profit") < 0, "loss")
        .when(F.col("profit") == 0, "break-even")
    )
    out = by_dimension(df.withColumn("profit_class", kind), ["profit_class"],
                       ["transactions", "profit"])
    return out.withColumn("row_share_pct", _share("transactions"))

"""Indicators, breakdowns and top lists."""

from __future__ import annotations

from weektide.operators import breakdowns as B
from weektide.operators import kpis, slicing
from weektide.plans import sql as S
from weektide.plans.registry import query, table

_SUMS = f"{S.total('sales')} AS sales, {S.total('profit')} AS profit"
_QTY = "CAST(sum(quantity) AS BIGINT) AS quantity"
_ORDERS = "count(DISTINCT order_id) AS orders"
_LINES = "count(sales) AS transactions"
_MARGIN = S.pct("profit", "sales")


@query(
    "core_kpis",
    f"""{S.WITH_T}, o AS (SELECT order_id, sum(sales) AS s, sum(profit) AS p FROM t GROUP BY 1),
a AS (SELECT {S.rnd(S.ratio('sum(s)', 'count(*)'))} AS average_order_value,
             {S.rnd(S.ratio('sum(p)', 'count(*)'))} AS average_profit_per_order FROM o),
b AS (SELECT {S.rnd(S.total('sales'))} AS total_sales, {S.rnd(S.total('profit'))} AS total_profit,
       CAST(sum(quantity) AS BIGINT) AS total_quantity,
       count(DISTINCT order_id) AS num_orders, count(DISTINCT customer_id) AS num_customers,
       count(DISTINCT product_id) AS num_products,
       {S.pct0('sum(profit)', 'sum(sales)')} AS overall_profit_margin_pct,
       {S.rnd(S.ratio('sum(quantity)', 'count(DISTINCT order_id)'))} AS average_items_per_order
FROM t) SELECT * FROM a, b""",
)
def _(spark, path):
    return kpis.core_kpis(
        table(spark, path, "order_id", "sales", "profit", "quantity"),
        ids=table(spark, path, "order_id", "customer_id", "product_id"),
    )


_EXECUTIVE = f"""SELECT {S.total('sales')} AS total_sales, {S.total('profit')} AS total_profit,
       coalesce({S.ratio('sum(profit)', 'sum(sales)')} * 100, 0.0) AS profit_margin,
       CAST(coalesce(sum(quantity), 0) AS BIGINT) AS total_units,
       count(DISTINCT order_id) AS total_orders,
       coalesce({S.ratio('sum(sales)', 'count(DISTINCT order_id)')}, 0.0) AS aov,
       count(*) AS rows FROM t"""


@query("executive_kpis", S.WITH_T + _EXECUTIVE)
def _(spark, path):
    return kpis.executive_kpis(table(spark, path, "order_id", "sales", "profit", "quantity"))


@query(
    "sliced_kpis",
    f"{S.WITH_T} {_EXECUTIVE} WHERE year(order_date) = 1998 AND segment = 'BUILDING'",
)
def _(spark, path):
    t = table(
        spark, path, "order_id", "order_date", "segment", "sales", "profit", "quantity"
    )
    return kpis.executive_kpis(slicing.slice_rows(t, year=1998, segment="BUILDING"))


@query(
    "category_performance",
    f"""{S.WITH_T}, g AS (SELECT category, {_SUMS}, {_QTY}, {_ORDERS}, {_LINES} FROM t GROUP BY 1)
SELECT *, {S.pct('sales', 'sum(sales) OVER ()')} AS sales_share_pct,
       {_MARGIN} AS profit_margin_pct FROM g""",
)
def _(spark, path):
    return B.category_performance(
        table(spark, path, "category", "order_id", "sales", "profit", "quantity")
    )


@query(
    "category_contribution",
    f"""{S.WITH_T}, g AS (SELECT category, {_SUMS} FROM t GROUP BY 1)
SELECT *, {S.pct('profit', 'sales', 1)} AS margin_pct FROM g""",
)
def _(spark, path):
    return B.category_contribution(table(spark, path, "category", "sales", "profit"))


@query(
    "subcategory_performance",
    f"""{S.WITH_T}, g AS (SELECT category, sub_category, {_SUMS}, {_QTY}, {_LINES},
       {S.rnd(S.ratio('sum(discount)', 'count(discount)'), 6)} AS avg_discount,
       {S.rnd(S.ratio('sum(discount)', 'count(discount)') + ' * 100')} AS avg_discount_pct
FROM t GROUP BY 1, 2)
SELECT *, {_MARGIN} AS profit_margin_pct FROM g""",
)
def _(spark, path):
    return B.subcategory_performance(
        table(spark, path, "category", "sub_category", "sales", "profit", "quantity", "discount")
    )


@query(
    "regional_performance",
    f"""{S.WITH_T}, g AS (SELECT region, {_SUMS}, {_QTY}, {_ORDERS}, {_LINES} FROM t GROUP BY 1)
SELECT *, {_MARGIN} AS profit_margin_pct FROM g""",
)
def _(spark, path):
    return B.regional_performance(
        table(spark, path, "region", "order_id", "sales", "profit", "quantity")
    )


@query(
    "segment_performance",
    f"""{S.WITH_T}, g AS (SELECT segment, {_SUMS}, {_ORDERS}, {_QTY} FROM t GROUP BY 1)
SELECT *, {_MARGIN} AS profit_margin_pct, {S.rnd(S.ratio('sales', 'orders'))} AS aov FROM g""",
)
def _(spark, path):
    return B.segment_performance(
        table(spark, path, "segment", "order_id", "sales", "profit", "quantity")
    )


@query(
    "ship_mode",
    f"""{S.WITH_T}, g AS (SELECT ship_mode, {_LINES}, {_SUMS},
       {S.rnd(S.ratio('sum(ship_date - order_date)', 'count(ship_date - order_date)'))} AS mean_lead_days,
       CAST(min(ship_date - order_date) AS BIGINT) AS min_lead_days,
       CAST(max(ship_date - order_date) AS BIGINT) AS max_lead_days FROM t GROUP BY 1)
SELECT *, {_MARGIN} AS profit_margin_pct FROM g""",
)
def _(spark, path):
    return B.ship_mode_performance(
        table(spark, path, "ship_mode", "order_date", "ship_date", "sales", "profit")
    )


def _tiers_sql(edges: list[float], labels: list[str]) -> str:
    spine = ", ".join(
        f"(CAST({i} AS BIGINT), '{label}', CAST({low} AS DOUBLE), CAST({high} AS DOUBLE))"
        for i, (label, low, high) in enumerate(zip(labels, edges, edges[1:]), start=1)
    )
    return f"""{S.WITH_T}, g AS (
  SELECT tier, discount_tier, {_LINES}, {_SUMS},
         CAST(coalesce(sum(quantity), 0) AS BIGINT) AS quantity
  FROM (VALUES {spine}) AS b(tier, discount_tier, low, high)
  LEFT JOIN t ON CAST(discount AS DOUBLE) > low AND CAST(discount AS DOUBLE) <= high
  GROUP BY ALL)
SELECT *, {S.pct0('profit', 'sales')} AS profit_margin_pct FROM g"""


_FINE_EDGES = [-0.001, 0.0, 0.02, 0.04, 0.06, 0.10]
_FINE_LABELS = ["none", "up to 2%", "2% - 4%", "4% - 6%", "6% - 10%"]


@query("discount_tiers", _tiers_sql(B.DISCOUNT_EDGES, B.DISCOUNT_LABELS))
def _(spark, path):
    return B.discount_tiers(table(spark, path, "discount", "sales", "profit", "quantity"))


@query("discount_tiers_fine", _tiers_sql(_FINE_EDGES, _FINE_LABELS))
def _(spark, path):
    return B.discount_tiers(
        table(spark, path, "discount", "sales", "profit", "quantity"), _FINE_EDGES, _FINE_LABELS
    )


_YEARS = f"""{S.WITH_T}, g AS (SELECT year(order_date) AS year, {_SUMS}, {_ORDERS}, {_QTY}
FROM t GROUP BY 1)"""


@query(
    "yearly",
    f"""{_YEARS} SELECT *, {_MARGIN} AS profit_margin_pct FROM g""",
)
def _(spark, path):
    return B.yearly(
        table(spark, path, "order_date", "order_id", "sales", "profit", "quantity")
    ).drop("yoy_growth_pct")


@query(
    "yoy_growth",
    f"""{_YEARS} SELECT year, sales,
       {S.rnd("(sales / nullif(lag(sales) OVER (ORDER BY year), 0) - 1) * 100")} AS yoy_growth_pct
FROM g""",
)
def _(spark, path):
    return B.yearly(table(spark, path, "order_date", "sales")).select("year", "sales", "yoy_growth_pct")


@query(
    "overall_growth",
    f"""{_YEARS} SELECT min(year) AS first_year, max(year) AS last_year,
       {S.rnd("(arg_max(sales, year) / arg_min(sales, year) - 1) * 100")} AS growth_pct FROM g""",
)
def _(spark, path):
    return B.overall_growth(table(spark, path, "order_date", "sales"))


@query(
    "month_seasonality",
    f"""{S.WITH_T}, g AS (SELECT month(order_date) AS month, {_SUMS} FROM t GROUP BY 1)
SELECT *, strftime(make_date(2000, month, 1), '%b') AS month_name,
       {S.pct('sales', 'sum(sales) OVER ()')} AS sales_share_pct FROM g""",
)
def _(spark, path):
    return B.month_seasonality(table(spark, path, "order_date", "sales", "profit"))


@query(
    "monthly_sales",
    f"""{S.WITH_T} SELECT strftime(order_date, '%Y-%m') AS year_month, {S.total('sales')} AS sales
FROM t WHERE region = 'EUROPE' GROUP BY 1""",
)
def _(spark, path):
    t = table(spark, path, "order_date", "region", "sales")
    return B.monthly_sales(slicing.slice_rows(t, region="EUROPE"))


@query(
    "subcategory_profit",
    f"""{S.WITH_T}, g AS (SELECT sub_category, {S.total('profit')} AS profit
FROM t WHERE region = 'AMERICA' GROUP BY 1)
SELECT *, CASE WHEN profit < 0 THEN 'loss' ELSE 'profit' END AS sign FROM g""",
)
def _(spark, path):
    t = table(spark, path, "sub_category", "region", "profit")
    return B.subcategory_profit(slicing.slice_rows(t, region="AMERICA"))


@query(
    "top_states",
    f"""{S.WITH_T} SELECT state, {_ORDERS}, {_SUMS} FROM t GROUP BY 1
ORDER BY sales DESC, state LIMIT 10""",
)
def _(spark, path):
    return B.top_states(table(spark, path, "state", "order_id", "sales", "profit"))


@query(
    "state_extremes",
    f"""{S.WITH_T}, g AS (SELECT state, {_SUMS}, {_ORDERS} FROM t GROUP BY 1),
m AS (SELECT *, {_MARGIN} AS margin_pct FROM g)
SELECT * FROM (SELECT *, 'top' AS side FROM m ORDER BY profit DESC, state LIMIT 5)
UNION ALL SELECT * FROM (SELECT *, 'bottom' AS side FROM m ORDER BY profit, state LIMIT 5)""",
)
def _(spark, path):
    return B.state_extremes(table(spark, path, "state", "order_id", "sales", "profit"))


@query(
    "subcategory_extremes",
    f"""{S.WITH_T}, g AS (SELECT sub_category, {S.total('profit')} AS profit FROM t GROUP BY 1)
SELECT * FROM (SELECT *, 'top' AS side FROM g ORDER BY profit DESC, sub_category LIMIT 5)
UNION ALL SELECT * FROM (SELECT *, 'bottom' AS side FROM g ORDER BY profit, sub_category DESC LIMIT 3)""",
)
def _(spark, path):
    totals = B.by_dimension(table(spark, path, "sub_category", "profit"), ["sub_category"], ["profit"])
    return B.best_and_worst(totals, "profit", "sub_category", head=5, tail=3)


@query(
    "top_transactions",
    f"""{S.WITH_T} SELECT row_id, order_id, product_id, product_name, CAST(sales AS DOUBLE) AS sales,
       quantity, CAST(profit AS DOUBLE) AS profit FROM t
ORDER BY sales DESC, order_id, product_id, row_id LIMIT 3""",
)
def _(spark, path):
    return B.top_transactions(
        table(spark, path, "row_id", "order_id", "product_id", "product_name", "sales",
              "quantity", "profit")
    )


_PRODUCTS = f"{S.WITH_T}, p AS (SELECT product_id, {_SUMS}, {_ORDERS} FROM t GROUP BY 1)"


@query(
    "product_concentration",
    f"""{_PRODUCTS}, r AS (SELECT *, row_number() OVER (ORDER BY sales DESC, product_id) AS k FROM p)
SELECT CAST(50 AS BIGINT) AS top_n, {S.rnd('sum(sales) FILTER (k <= 50)')} AS top_sales,
       {S.rnd('sum(sales)')} AS total_sales,
       {S.pct('sum(sales) FILTER (k <= 50)', 'sum(sales)')} AS share_pct FROM r""",
)
def _(spark, path):
    return B.product_concentration(table(spark, path, "product_id", "sales"))


@query(
    "top_products",
    f"""{_PRODUCTS}
SELECT * FROM (SELECT *, 'top_sales' AS list FROM p ORDER BY sales DESC, product_id LIMIT 5)
UNION ALL
SELECT * FROM (SELECT *, 'worst_profit' AS list FROM p ORDER BY profit, product_id LIMIT 3)""",
)
def _(spark, path):
    return B.top_products(table(spark, path, "product_id", "order_id", "sales", "profit"))


def _topk_sql(dimension: str, k: int) -> str:
    return f"{S.WITH_T}, g AS (SELECT {dimension}, {_SUMS} FROM t GROUP BY 1)\n" + " UNION ALL ".join(
        f"""SELECT '{dimension}' AS dimension, '{m}' AS measure, CAST({k} AS BIGINT) AS k,
       {S.pct(f'sum({m}) FILTER (r <= {k})', f'sum({m})')} AS share_pct
FROM (SELECT *, row_number() OVER (ORDER BY {m} DESC, {dimension}) AS r FROM g)"""
        for m in ("sales", "profit")
    )


@query("topk_share", _topk_sql("region", 2))
def _(spark, path):
    return B.topk_share(table(spark, path, "region", "sales", "profit"), "region", 2)


@query("topk_share_states", _topk_sql("state", 5))
def _(spark, path):
    return B.topk_share(table(spark, path, "state", "sales", "profit"), "state", 5)


@query(
    "month_year_pivot",
    S.WITH_T + """SELECT month(order_date) AS month, year(order_date) AS year,
       CAST(sum(sales) AS DOUBLE) AS sales FROM t GROUP BY ALL""",
)
def _(spark, path):
    return B.month_year_sales(table(spark, path, "order_date", "sales"))


_M = ["sales", "quantity", "discount", "profit"]


def _corr_sql(a: str) -> str:
    cells = ", ".join(
        "1.0::DOUBLE AS " + b if a == b
        else S.rnd(f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))", 6) + f" AS {b}"
        for b in _M
    )
    return f"SELECT '{a}' AS \"column\", {cells} FROM t"


@query("correlation_matrix", S.WITH_T + " UNION ALL ".join(_corr_sql(a) for a in _M))
def _(spark, path):
    return B.correlation_matrix(table(spark, path, *_M))


def _mean_discount(side: str) -> str:
    return S.rnd(
        S.ratio(f"sum(discount) FILTER ({side})", f"count(discount) FILTER ({side})") + " * 100"
    )


@query(
    "discount_by_profit_sign",
    f"""{S.WITH_T} SELECT count(*) FILTER (profit < 0) AS loss_rows,
       {S.pct('count(*) FILTER (profit < 0)', 'count(*)')} AS loss_pct,
       {_mean_discount('profit < 0')} AS loss_discount_pct,
       {_mean_discount('profit >= 0')} AS gain_discount_pct FROM t""",
)
def _(spark, path):
    return B.discount_by_profit_sign(table(spark, path, "profit", "discount"))


@query(
    "profit_classes",
    f"""{S.WITH_T}, g AS (SELECT CASE WHEN profit > 0 THEN 'profit' WHEN profit < 0 THEN 'loss'
       ELSE 'break-even' END AS profit_class, {_LINES}, {S.total('profit')} AS profit
FROM t GROUP BY 1)
SELECT *, {S.pct('transactions', 'sum(transactions) OVER ()')} AS row_share_pct FROM g""",
)
def _(spark, path):
    return B.profit_classes(table(spark, path, "sales", "profit"))


@query(
    "day_of_week",
    f"""{S.WITH_T}, g AS (SELECT isodow(order_date) AS weekday, {_LINES}, {S.total('sales')} AS sales
FROM t GROUP BY 1)
SELECT *, {S.pct('transactions', 'sum(transactions) OVER ()')} AS transaction_share_pct,
       {S.pct('sales', 'sum(sales) OVER ()')} AS sales_share_pct FROM g""",
)
def _(spark, path):
    return B.day_of_week(table(spark, path, "order_date", "sales"))

"""Tables published by version and sketches stored beside a table."""

from __future__ import annotations

from pyspark.sql import functions as F

from weektide.operators.sketches import distinct_from_sketches, monthly_sketches, standard_error
from weektide.plans import sql as S
from weektide.plans.registry import query, table
from weektide.sources.durable import shared_path, stored
from weektide.sources.publish import history, publish, read_published


@query(
    "publish_incremental",
    f"""{S.WITH_T} SELECT year(order_date) AS order_year, count(*) AS n_rows,
       CAST(sum(quantity + CASE WHEN year(order_date) % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS quantity,
       year(order_date) % 3 = 0 AS written
FROM t GROUP BY ALL""",
)
def _(spark, path):
    """Sales published twice, with every third year corrected in between: what readers
    see, and which years the second version wrote."""
    sales = table(spark, path, "row_id", "order_date", "order_id", "quantity", "sales")
    sales = stored(sales.withColumn("order_year", F.year("order_date")), "sales")
    root = shared_path(spark, "published")
    publish(sales, root, "order_year")
    late = F.when(F.col("order_year") % 3 == 0, F.col("quantity") + 1)
    version = publish(
        sales.withColumn("quantity", F.coalesce(late, "quantity")), root, "order_year"
    )
    seen = read_published(spark, root).groupBy("order_year").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("quantity").alias("quantity")
    )
    names = history(spark, root).filter(F.col("version") == version)
    return seen.join(names.select(F.col("value").cast("int").alias("order_year"), "written"), "order_year")


@query(
    "distinct_from_sketches",
    f"""{S.WITH_T} SELECT year(order_date) AS order_year, count(*) AS n_rows,
       count(DISTINCT order_id) AS orders, count(DISTINCT customer_id) AS customers,
       TRUE AS orders_within, TRUE AS customers_within
FROM t GROUP BY ALL""",
)
def _(spark, path):
    """Orders and customers of each year, exact, and whether the count from the months'
    sketches lies within four standard errors."""
    columns = ["order_id", "customer_id"]
    sales = table(spark, path, "order_date", *columns)
    months = stored(monthly_sketches(sales, columns), "sketches")
    by_year = months.withColumn("order_year", F.year("month"))
    estimated = distinct_from_sketches(by_year, columns, ["order_year"])
    exact = sales.groupBy(F.year("order_date").alias("order_year")).agg(
        F.countDistinct("order_id").alias("orders"),
        F.countDistinct("customer_id").alias("customers"),
    )

    def within(estimate: str, count: str):
        allowed = F.greatest(F.lit(1.0), F.col(count) * (4 * standard_error()))
        return (F.abs(F.col(estimate) - F.col(count)) <= allowed).alias(f"{count}_within")

    return exact.join(estimated, "order_year").select(
        "order_year", F.col("rows").alias("n_rows"), "orders", "customers",
        within("order_id", "orders"), within("customer_id", "customers"),
    )

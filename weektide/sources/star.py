"""The transactions table as a view over a star schema.

Every dimension hangs on the fact by a LEFT join on its primary key, so the row
set is that of the fact whichever columns are asked for.  That makes it correct
to leave out the dimensions a query does not touch: ``transactions(..., columns)``
reads and shuffles only what those columns need.  No side is hinted: Spark
broadcasts a dimension only while its size is under
``spark.sql.autoBroadcastJoinThreshold`` and otherwise merge-joins it, splitting
skewed keys of the fact side at run time.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FROM_REGION = {"region"}
_FROM_NATION = {"state"} | _FROM_REGION
_FROM_CUSTOMER = {"customer_name", "segment"} | _FROM_NATION
_FROM_ORDERS = {"order_date", "ship_mode", "customer_id"} | _FROM_CUSTOMER
_FROM_PART = {"category", "sub_category", "product_name", "profit"}

COLUMNS = [
    "row_id", "order_id", "order_date", "ship_date", "ship_mode",
    "customer_id", "customer_name", "segment", "state", "region",
    "product_id", "category", "sub_category", "product_name",
    "sales", "quantity", "discount", "profit",
]


def colocate(
    spark: SparkSession, path: str, prefix: str, buckets: int
) -> dict[str, DataFrame]:
    """Fact and orders stored as tables ``<prefix>_lineitem`` and ``<prefix>_orders``, both
    bucketed and sorted by the order's key.

    Queries that get them as ``tables`` join the two bucket by bucket: the fact is never
    shuffled for its order, however large the orders are.  Choose ``buckets`` so that one of
    the fact's fits in a task (about 256 MB of the columns that queries read); rows are dealt
    by key before they are written, so a bucket is one file.  Existing tables of these
    names make it fail.
    """
    stored = {}
    for name, key in (("lineitem", "l_orderkey"), ("orders", "o_orderkey")):
        dealt = spark.read.parquet(f"{path}/{name}.parquet").repartition(buckets, key)
        dealt.write.bucketBy(buckets, key).sortBy(key).saveAsTable(f"{prefix}_{name}")
        stored[name] = spark.table(f"{prefix}_{name}")
    return stored


def transactions(
    spark: SparkSession,
    path: str,
    columns: Iterable[str] | None = None,
    tables: dict[str, DataFrame] | None = None,
) -> DataFrame:
    """Canonical transactions, restricted to ``columns`` (default: all 18).

    ``tables`` stands in for files of the same name, such as those of ``colocate``.
    """
    wanted = list(COLUMNS if columns is None else columns)
    unknown = [c for c in wanted if c not in COLUMNS]
    if unknown:
        raise ValueError(f"unknown transaction columns: {unknown}")
    need = set(wanted)

    def table(name: str) -> DataFrame:
        if tables and name in tables:
            return tables[name]
        return spark.read.parquet(f"{path}/{name}.parquet")

    out = table("lineitem")
    if need & _FROM_PART:
        out = out.join(table("part"), F.col("l_partkey") == F.col("p_partkey"), "left")
    if need & _FROM_ORDERS:
        # Dimensions of the order are attached to the smaller side first.
        orders = table("orders")
        if need & _FROM_CUSTOMER:
            customer = table("customer")
            if need & _FROM_NATION:
                customer = customer.join(
                    table("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left"
                )
            if need & _FROM_REGION:
                customer = customer.join(
                    table("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
                )
            orders = orders.join(
                customer, F.col("o_custkey") == F.col("c_custkey"), "left"
            )
        out = out.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")

    # Prices and rates have two decimals: whole hundredths multiply exactly.
    def hundredths(name: str):
        return F.rint(F.col(name) * 100).cast("bigint")

    quantity = F.col("l_quantity").cast("bigint")
    rate = hundredths("l_discount")
    sales = hundredths("l_extendedprice") * (F.lit(100) - rate)
    cost = quantity * hundredths("p_retailprice") * 100
    exprs = {
        "row_id": F.col("l_orderkey") * 10 + F.col("l_linenumber"),
        "order_id": F.col("l_orderkey"),
        "order_date": F.col("o_orderdate").cast("date"),
        "ship_date": F.col("l_shipdate").cast("date"),
        "ship_mode": F.col("o_orderpriority"),
        "customer_id": F.col("o_custkey"),
        "customer_name": F.col("c_name"),
        "segment": F.col("c_mktsegment"),
        "state": F.col("n_name"),
        "region": F.col("r_name"),
        "product_id": F.col("l_partkey"),
        "category": F.col("p_type"),
        "sub_category": F.col("p_brand"),
        "product_name": F.col("p_name"),
        "sales": sales / 10000.0,
        "quantity": quantity,
        "discount": rate / 100.0,
        "profit": (sales - cost) / 10000.0,
    }
    return out.select(*[exprs[c].alias(c) for c in wanted])

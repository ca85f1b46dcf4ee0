"""Weekly totals kept up to date as transactions arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from weektide.functions.numeric import total


def weekly_totals(
    transactions: DataFrame,
    keys: list[str] | None = None,
    date_col: str = "order_date",
    lateness: str = "7 days",
) -> DataFrame:
    """Sales, profit, quantity and lines per week ending on Sunday.

    Works on a stream and on a table.  On a stream a week is final, and is
    emitted, once the newest day seen is ``lateness`` past its end; state holds
    open weeks only.  Weeks are aligned to Monday by the four-day offset of the
    epoch, a Thursday.  Distinct orders are left to the batch table: counting
    them exactly would keep every order id in state.
    """
    week = F.window("__at", "7 days", "7 days", "4 days")
    return (
        transactions.withColumn("__at", F.col(date_col).cast("timestamp"))
        .withWatermark("__at", lateness)
        .groupBy(*(keys or []), week.alias("week"))
        .agg(
            total(F.col("sales")).alias("sales"),
            total(F.col("profit")).alias("profit"),
            F.coalesce(F.sum("quantity"), F.lit(0)).alias("quantity"),
            F.count(F.lit(1)).alias("lines"),
        )
        .select(
            *(keys or []), F.date_sub(F.col("week.end").cast("date"), 1).alias("date"),
            "sales", "profit", "quantity", "lines",
        )
    )


def append_closed_weeks(
    weekly: DataFrame, path: str, checkpoint: str
) -> StreamingQuery:
    """Start appending closed weeks to a Parquet table and stop when caught up.

    The checkpoint folder remembers progress: the next start, say after the
    Sunday close, takes up the files that arrived since.
    """
    return (
        weekly.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )

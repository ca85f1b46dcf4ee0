"""Intermediate tables in the shared folder, and settings for rows that hold long texts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weektide.session import tune
from weektide.sources.durable import checkpoint_dir

#: Rows that Spark hands to Python at a time: documents are long, so few of them.
BATCH_ROWS = 512
#: Ids that are sent to every task rather than joined by a shuffle: 8 bytes each.
SENT_IDS = 200_000


def tuned(spark: SparkSession) -> SparkSession:
    """The library's session settings, and small batches for Python."""
    tune(spark).conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the session's checkpoint folder, which all executors reach."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    The plan of the result starts at those files: reading it again costs a scan,
    and a lost executor loses nothing of it.  Empty tables keep their schema.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def sent_if_few(ids: DataFrame, name: str) -> DataFrame:
    """Ids, stored; marked for broadcast if there are at most ``SENT_IDS`` of them.

    Beyond that Spark joins them by a shuffle, as it would anyway.
    """
    ids = stored(ids, name)
    return F.broadcast(ids) if ids.count() <= SENT_IDS else ids


def shuffle_width(spark: SparkSession) -> int:
    """Shuffle partitions of the session: what one task gets shrinks as it grows."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def width_for(spark: SparkSession, amount: int, each: int) -> int:
    """Shuffle partitions of which each gets about ``each`` of ``amount``, and no fewer than
    the session's: the number follows the input, not only the setting."""
    return max(shuffle_width(spark), -(-amount // each))

"""Session settings the queries rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Split a skewed join partition even where that costs the plan one more shuffle:
# joins and aggregates here often share a key, and a key may hold a third of all rows.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

#: Data one shuffle task should sort or hash, small enough to stay in memory.
TASK_BYTES = 256 << 20


def tune(spark: SparkSession, shuffle_bytes: int | None = None) -> SparkSession:
    """Apply ``SETTINGS`` to a session; all can change while it runs.

    AQE merges small shuffle partitions but cannot make more of them, so the
    number to start from has to suit the largest shuffle.  ``shuffle_bytes``, the
    expected size of that shuffle, raises it to ``TASK_BYTES`` per task.
    """
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    if shuffle_bytes is not None:
        present = int(spark.conf.get("spark.sql.shuffle.partitions"))
        wanted = -(-shuffle_bytes // TASK_BYTES)
        spark.conf.set("spark.sql.shuffle.partitions", str(max(present, wanted)))
    return spark

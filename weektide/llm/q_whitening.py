"""Query op13: whitened embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weektide.llm.registry import query, read
from weektide.llm.whitening import whiten


@query("op13_whitening")
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """The leading whitened components of every embedding; eigenvectors are beyond SQL."""
    return whiten(read(spark, folder, "embeddings"), "vec_id", "embedding")

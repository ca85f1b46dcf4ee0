"""Query op9: digests of documents and of their edited texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weektide.llm.fingerprint import fingerprints
from weektide.llm.registry import query, read


@query("op9_fingerprint")
def op9_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """Digest, edited digest and likeness of every document."""
    return fingerprints(read(spark, folder, "documents"))

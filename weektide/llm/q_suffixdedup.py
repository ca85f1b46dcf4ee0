"""Query op3: documents without strings that occur earlier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weektide.llm.registry import query, read
from weektide.llm.suffixdedup import remove_repeats


@query("op3_suffixdedup")
def op3_suffixdedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes, removed bytes and runs, and the digest of what is left of every document."""
    return remove_repeats(read(spark, folder, "documents"))

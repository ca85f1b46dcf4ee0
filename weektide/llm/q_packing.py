"""Query op1: all documents packed into sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from weektide.llm.packing import pack
from weektide.llm.registry import query, read


@query("op1_packing")
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document with its sequence and offset."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return pack(read(spark, folder, "documents"), "doc_id", "text", path)

"""Query op7: tokens of every document."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from weektide.llm.registry import query, read
from weektide.llm.tokencount import token_counts


@query("op7_tokencount")
def op7_tokencount(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens, pre-tokens and characters of every document."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts(read(spark, folder, "documents"), "doc_id", "text", path)

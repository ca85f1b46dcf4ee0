"""Query op8: documents with pseudonyms for personal data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weektide.llm.pii import pseudonymise
from weektide.llm.registry import query, read

#: Key of the registered query and the pipeline; a real corpus has a secret one.
KEY = "an example key"


@query("op8_pii")
def op8_pii(spark: SparkSession, folder: str) -> DataFrame:
    """All documents, their text with pseudonyms."""
    return pseudonymise(read(spark, folder, "documents"), "text", KEY)

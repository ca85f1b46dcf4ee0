"""Query op2: the main text of every page."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weektide.llm.html import main_text
from weektide.llm.registry import query, read


@query("op2_html")
def op2_html(spark: SparkSession, folder: str) -> DataFrame:
    """Text and its length of every page."""
    return main_text(read(spark, folder, "pages"), "page_id", "url", "html")

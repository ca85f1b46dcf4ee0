"""Query op5: benchmark items inside documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weektide.llm.decontam import find_items
from weektide.llm.registry import query, read
from weektide.llm.words_sql import shingles

_SQL = f"""
WITH d AS ({shingles("documents", "doc_id")}), b AS ({shingles("benchmark", "item_id")}),
n AS (SELECT id, count(*) AS n_item FROM b GROUP BY id),
c AS (SELECT d.id AS doc_id, b.id AS item_id, count(*) AS n_common
      FROM d JOIN b USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n_item, n_common, n_common / n_item AS containment
FROM c JOIN n ON n.id = item_id WHERE 5 * n_common >= 4 * n_item
"""


@query("op5_decontam", _SQL)
def op5_decontam(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with each benchmark item it contains."""
    return find_items(read(spark, folder, "documents"), read(spark, folder, "benchmark"))

"""Query op10: groups of documents with similar shingle sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weektide.llm.jaccard import join_components
from weektide.llm.registry import query, read
from weektide.llm.words_sql import shingles

_SQL = f"""
WITH RECURSIVE d AS ({shingles("documents", "doc_id")}),
n AS (SELECT id, count(*) AS n FROM d GROUP BY id),
c AS (SELECT x.id AS a, y.id AS b, count(*) AS k FROM d x JOIN d y USING (s)
      WHERE x.id <> y.id GROUP BY ALL),
link AS (SELECT a, b FROM c JOIN n p ON p.id = a JOIN n q ON q.id = b
         WHERE 100 * k >= 80 * (p.n + q.n - k)),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
name AS (SELECT a, least(a, min(b)) AS m FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(m, doc_id) AS component_id
FROM documents LEFT JOIN n ON n.id = doc_id LEFT JOIN name ON a = doc_id
"""


@query("op10_jaccard", _SQL)
def op10_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Set size and component of every document."""
    return join_components(read(spark, folder, "documents"))

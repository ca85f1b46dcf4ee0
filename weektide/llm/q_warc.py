"""Query op4: pages written as archives and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weektide.llm import warc
from weektide.llm.registry import query, read
from weektide.llm.store import shared_path

_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS hex FROM pages),
d AS (
  SELECT page_id, strlen(body) AS payload_bytes,
    array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT + 1, 1)
      FOR i IN range(32)], '') AS payload_digest FROM p),
k AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS kept FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = kept THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id < kept THEN kept END AS refers_to FROM k
"""


@query("op4_warc", _SQL)
def op4_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Each page's record as the salvage reader finds it in the written archives."""
    path = shared_path(spark, "warc")
    plan = warc.plan_records(read(spark, folder, "pages"), "page_id", "url", "html")
    warc.write_archives(plan, path)
    records = warc.read_archives(spark, path).where("problem is null")
    return records.select(
        warc.page_number(F.col("record_id")).alias("page_id"),
        F.coalesce(F.length("payload").cast("bigint"), F.col("http_length")).alias("payload_bytes"),
        "payload_digest",
        "record_type",
        warc.page_number(F.col("refers_to")).alias("refers_to"),
    )

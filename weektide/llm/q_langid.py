"""Query op6: the language of every document."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weektide.llm.langid import Model, identify, train
from weektide.llm.registry import query, read


def held_out():
    """Documents that a model may not be fitted on."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2


def fitted(docs: DataFrame) -> Model:
    """The model of the rows with a label that are not held out."""
    return train(docs.where(~held_out()), "text", "lang")


@query("op6_langid")
def op6_langid(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language and its share of every document."""
    docs = read(spark, folder, "documents")
    found = identify(docs, "doc_id", "text", fitted(docs))
    return found.select(
        "doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"),
        "lang_pred", "score", "proportions",
    )

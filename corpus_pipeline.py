"""The corpus pipeline: from raw documents to packed token sequences.

Each stage works on all that the one before has kept and is written as Parquet.  All
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weektide.llm.decontam import find_items
from weektide.llm.jaccard import join_components
from weektide.llm.langid import identify
from weektide.llm.packing import pack
from weektide.llm.pii import pseudonymise
from weektide.llm.q_langid import fitted
from weektide.llm.q_pii import KEY
from weektide.llm.registry import read
from weektide.llm.store import sent_if_few, shared_path, stored, tuned

#: A document is rejected when no language makes up this share of it.
LEAST_SHARE = 0.3
#: It is rejected as well when it fits its main language worse than this (see
#: ``langid.measured``): documents in the model's languages lie above -1.4, but for one in
#: ten thousand very short ones; random letters and other languages lie from -2.7 down with
#: a model of some thousand documents, from -1.5 down with one of some hundred.
LEAST_FIT = -1.4


def _tag(name: str, df: DataFrame) -> str:
    """A column name that the documents don't have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of id and text, and the key's name.

    Ids may be NULL or shared by different texts, so a stage decides about these keys;
    rows that are equal in both share one, and what becomes of them.
    """
    name = _tag("row", docs)
    return docs.withColumn(name, F.xxhash64("doc_id", F.col("text").cast("string"))), name


def _without(keyed: DataFrame, row: str, rows: DataFrame) -> DataFrame:
    """``keyed`` without the rows whose key is in the one column of ``rows``, and without keys."""
    mark = _tag("marked", keyed)
    marks = sent_if_few(rows.toDF(mark).distinct(), "marks")
    return keyed.join(marks, F.col(row) == F.col(mark), "left_anti").drop(row)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, without a main language, or in none that is known, go."""
    tuned(spark)
    keyed, row = _keyed(docs)
    found = identify(keyed, row, "text", fitted(docs))
    unlike = F.coalesce(F.col("fit") < LEAST_FIT, F.lit(False))
    rejected = found.where((F.col("lang_pred") == "und") | (F.col("score") < LEAST_SHARE) | unlike)
    return _without(keyed, row, rejected.select("doc_id"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents the one with the smallest id stays.

    Of different texts with that id one stays, chosen by hash.  Rows without an id stay.
    """
    tuned(spark)
    keyed, row = _keyed(docs)
    found = join_components(keyed, row)
    copies = found.where("doc_id <> component_id").distinct()
    first = copies.select(F.col("component_id").alias("doc_id"), "component_id").distinct()
    grouped = sent_if_few(
        copies.select("doc_id", "component_id").unionByName(first)
        .select(F.col("doc_id").alias("member"), F.col("component_id").alias("group")), "grouped",
    )
    named = keyed.where("doc_id is not null").select(F.col(row).alias("member"), "doc_id")
    named = stored(named.join(grouped, "member"), "members")
    place = F.struct("doc_id", "member")
    least = sent_if_few(named.groupBy("group").agg(F.min(place).alias("least")), "least")
    gone = named.join(least, "group").where(place > F.col("least"))
    return _without(keyed, row, gone.select("member"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain an item of the benchmark go."""
    keyed, row = _keyed(docs)
    found = find_items(keyed, read(tuned(spark), sf_dir, "benchmark"), row)
    return _without(keyed, row, found.select("doc_id"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by pseudonyms; ``n_chars`` follows the text."""
    tuned(spark)
    out = pseudonymise(docs, "text", KEY)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    tuned(spark)
    return pack(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pseudonyms", pseudonyms),
    ("packing", packing),
]

#: SQL can express neither expectation-maximisation nor tokenizers; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    docs = read(tuned(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)

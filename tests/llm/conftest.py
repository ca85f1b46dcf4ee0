"""Small tables with everything that an operator has to bear."""

import random

import pytest
from pyspark.sql import types as T

#: Columns that operators use inside, and that tables may have as well.
CLASHING = (
    "key run component node a b bucket blob start length rank part place n parity members "
    "name id marked spans doc tag r times sequence at offset kept value path "
    "assign access hex entropy"
).split()


def _words(rng, n):
    return " ".join(
        "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n)
    )


def document_rows():
    rng = random.Random(7)
    base = _words(rng, 120)
    words = base.split()
    near = " ".join(words[:60] + ["changed"] + words[61:])
    other = _words(rng, 80)
    long = _words(rng, 30_000)
    texts = [
        None, "", "   \n\t", "one", "one two three", "One TWO three", base, base, near,
        other, other + " " + base, long, "12345 67890 !!", "x" * 500, "ab" * 400,
        "é" * 120 + " " + base.upper(), "日本語 テキスト 😀 " * 40, base + " " + base,
    ]
    rows = [(i, t, "en" if i % 2 else None) for i, t in enumerate(texts)]
    return rows + [rows[6], (None, base, "de"), (None, None, None), (99, None, "fr")]


def as_documents(spark, rows):
    fields = [
        T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ] + [T.StructField(c, T.StringType()) for c in CLASHING]
    full = [
        (i, t, lang, None, None if t is None else len(t), *["?"] * len(CLASHING))
        for i, t, lang in rows
    ]
    return spark.createDataFrame(full, T.StructType(fields))


@pytest.fixture(scope="session")
def rows():
    return document_rows()


@pytest.fixture(scope="session")
def documents(spark, rows):
    return as_documents(spark, rows).repartition(3).cache()


@pytest.fixture(scope="session")
def no_documents(spark):
    return as_documents(spark, [])

import random

import pytest

import corpus_pipeline
from conftest import CLASHING, as_documents
from test_decontam import brute as contained
from test_jaccard import brute as components
from test_langid import text_in
from test_packing import check_pieces
from weektide.llm.langid import has_letter

FUNCTIONS = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    """The small table with texts of two languages added, and a benchmark."""
    rng = random.Random(8)
    more = [(200 + k, text_in(lang, 40, rng), lang) for k, lang in enumerate(["aa", "bb"] * 30)]
    data = [(i, t, None) for i, t, _ in rows] + more
    data[10] = (10, more[0][1] + " card 4111111111111111 of 2001-02-03", "aa")
    path = f"file://{tmp_path_factory.mktemp('corpus')}"
    as_documents(spark, data).write.parquet(f"{path}/documents.parquet")
    asked = [(1, " ".join(rows[9][1].split()[5:40])), (2, " ".join(more[5][1].split()[3:20])), (3, None)]
    spark.createDataFrame(asked, "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, data, asked


def as_rows(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_stages_against_brute_force(spark, folder):
    path, data, asked = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    assert set(CLASHING) <= set(columns)

    # Language: what has no letters goes; the rest has a language of its own.
    docs = FUNCTIONS["language"](spark, docs, path)
    left = [(i, t, lang) for i, t, lang in data if has_letter(t) and i != 16]
    kept = as_rows(docs)
    assert set(kept) <= {(i, t) for i, t, _ in data if has_letter(t)}
    assert {i for i, _ in kept} >= {i for i, _, lang in left if lang}
    data = [(i, t, None) for i, t in kept]

    # Near duplicates: of each group the smallest id stays; rows without an id stay too.
    docs = FUNCTIONS["near_duplicates"](spark, docs, path)
    gone = {i for i, _, name in components(data) if i is not None and name != i}
    assert as_rows(docs) == sorted(((i, t) for i, t, _ in data if i not in gone), key=str)
    assert gone
    data = [r for r in data if r[0] not in gone]

    # Benchmark: documents with an item go.
    docs = FUNCTIONS["decontaminate"](spark, docs, path)
    leaks = {doc for doc, *_ in contained(data, asked)}
    assert leaks and as_rows(docs) == sorted(((i, t) for i, t, _ in data if i not in leaks), key=str)

    # Pseudonyms: rows stay, personal data changes, lengths follow.
    before = as_rows(docs)
    docs = FUNCTIONS["pseudonyms"](spark, docs, path)
    assert docs.columns == columns
    changed = [(a, b) for a, b in zip(before, as_rows(docs), strict=True) if a != b]
    assert [a[0] for a, _ in changed] == [10]
    assert "4111111111111111" not in changed[0][1][1] and "2001-02-03" not in changed[0][1][1]
    assert all(r.n_chars == len(r.text) for r in docs.select("text", "n_chars").collect())

    # Packing: every id of what is left in one piece.
    got = FUNCTIONS["packing"](spark, docs, path).collect()
    check_pieces(got, as_rows(docs))


def test_run_joins_the_stages(spark, folder):
    path, data, _ = folder
    got = corpus_pipeline.run(spark, path)
    assert got.columns[:5] == ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    ids = {r.doc_id for r in got.collect()}
    assert ids < {i for i, *_ in data} and 10 in ids


def test_stages_decide_by_row(spark, tmp_path):
    """Rows without an id, and different texts of one id, don't share their fate."""
    rng = random.Random(11)
    clean = [text_in(lang, 60, rng) for lang in ["aa", "bb"] * 8]
    near = clean[0].upper()  # another text with the same shingles
    more = [(200 + k, text_in(lang, 40, rng), lang) for k, lang in enumerate(["aa", "bb"] * 30)]
    path = f"file://{tmp_path}"
    item = " ".join(clean[2].split()[5:40])
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")

    def left(stage, rows):
        as_documents(spark, rows).write.mode("overwrite").parquet(f"{path}/docs.parquet")
        return as_rows(FUNCTIONS[stage](spark, spark.read.parquet(f"{path}/docs.parquet"), path))

    def want(rows):
        return sorted(((i, t) for i, t, _ in rows), key=str)

    kept = [(None, clean[0], "aa"), (7, clean[1], "bb"), (8, clean[3], "bb"), (8, clean[3], "bb")]
    junk = [(None, None, "aa"), (None, "12 34", "aa"), (7, "...", "bb"), (7, "...", "bb"), (9, "", "bb")]
    assert left("language", more + kept + junk) == want(more + kept)

    leaks = [(None, clean[2], None), (7, "x " + clean[2], None), (7, "x " + clean[2], None)]
    assert left("decontaminate", kept + leaks) == want(kept)

    kept = [(3, clean[0], None), (5, clean[1], None), (None, clean[4], None), (None, None, None), (6, clean[5], None)]
    copies = [(5, near, None), (4, clean[0], None), (6, near, None), (6, near, None)]
    assert left("near_duplicates", kept + copies) == want(kept)
    # One of two similar texts with the smallest id stays.
    both = left("near_duplicates", [(3, clean[0], None), (3, near, None), (4, near, None), (5, clean[1], None)])
    assert len(both) == 2 and both[0][0] == 3 and both[1] == (5, clean[1])

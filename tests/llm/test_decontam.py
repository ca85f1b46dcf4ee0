import random

from conftest import as_documents
from weektide.llm.decontam import find_items, shingles_of, words_of


def items(spark, rows):
    return spark.createDataFrame([(*r, "x", "x") for r in rows], "item_id bigint, text string, id string, doc_id string")


def brute(rows, asked):
    out = set()
    for doc, text, _ in rows:
        words = words_of(text)
        for item, want in asked:
            sought = words_of(want)
            width = min(5, len(sought))
            if width:
                exact = shingles_of(sought, width)
                common = len(exact & shingles_of(words, width))
                if 5 * common >= 4 * len(exact):
                    out.add((doc, item, len(exact), common))
    return out


def run(docs, asked, **options):
    return {tuple(r)[:4] for r in find_items(docs, asked, **options).collect()}


def test_against_brute_force(spark, documents, rows):
    base = rows[6][1].split()
    asked = [
        (1, " ".join(base[10:40])), (2, " ".join(base[:12]).upper()), (3, "one two"), (4, None),
        (5, ""), (6, " ".join(base[5:30] + ["zz"] + base[31:50])), (7, "not in there at all my friend"),
        (None, " ".join(base[50:70])), (1, " ".join(base[10:40])), (8, rows[11][1][:4000]), (9, "  "),
    ]
    want = brute(rows, asked)
    assert len(want) > 15
    assert run(documents, items(spark, asked)) == want
    assert run(documents, items(spark, asked), block=16) == want


def test_partial_leaks_around_the_threshold(spark):
    rng = random.Random(9)
    filler = [f"f{k}" for k in range(3000)]
    asked = [(k, " ".join(f"w{k}x{rng.randrange(9999)}" for _ in range(rng.choice([5, 9, 24, 60])))) for k in range(20)]
    rows = []
    for k, text in asked:
        for edits in range(4):
            words = text.split()
            for _ in range(edits):
                words[rng.randrange(len(words))] = "edited"
            spot = rng.randrange(len(filler))
            rows.append((len(rows), " ".join(filler[:spot] + words + filler[spot:]), None))
    want = brute(rows, asked)
    assert 20 <= len(want) < len(rows)
    assert run(as_documents(spark, rows), items(spark, asked)) == want


def test_empty_tables(spark, documents, no_documents):
    assert run(no_documents, items(spark, [(1, "a b c d e f")])) == set()
    assert run(documents, items(spark, [])) == set()

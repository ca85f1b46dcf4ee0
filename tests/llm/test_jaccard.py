import random
import re

import numpy as np
import pyarrow as pa
import pytest

from conftest import as_documents
from weektide.llm import jaccard
from weektide.llm.components import components
from weektide.llm.grams import shingle_sets

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    """Set size and smallest reachable id of every row; ids may be NULL and repeat."""
    sets = [shingles(t) for _, t, _ in rows]
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= 80 * len(sets[i] | sets[j]):
                group[root(i)] = root(j)
    out = []
    for i, (doc, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(ids, default=None)))
    return sorted(out, key=str)


def run(df):
    return sorted((tuple(r) for r in jaccard.join_components(df).collect()), key=str)


def test_components(documents, rows):
    assert run(documents) == brute(rows)


def test_no_documents(no_documents):
    assert run(no_documents) == []


@pytest.mark.parametrize("most", [jaccard.MOST, 4])
def test_edits_around_the_threshold(spark, monkeypatch, most):
    monkeypatch.setattr(jaccard, "MOST", most)
    rng = random.Random(11)
    rows = []
    for group in range(12):
        words = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([5, 8, 30, 150, 400]))]
        for _ in range(6):
            copy = list(words)
            for _ in range(rng.randrange(0, max(2, len(words) // 30))):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy[rng.randrange(0, 3):]), None))
    passage = " ".join(f"p{k}" for k in range(60))
    rows += [(1000 + k, passage + " " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(25)), None)
             for k in range(30)]
    assert run(as_documents(spark, rows)) == brute(rows)


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(2)
    for size in [1, 2, 3, 4, 5, 6, 7, 9, 13, 20, 45, 200, 900]:
        for _ in range(20):
            base = rng.integers(0, 2**63, size).astype(np.uint64)
            other = base.copy()
            edits = size // 9
            if edits:  # each edit changes two members of the union
                spots = rng.choice(size, edits, replace=False)
                other[spots] = rng.integers(0, 2**63, edits).astype(np.uint64)
            found = np.concatenate([np.sort(base), np.sort(other)])
            seen = {0: set(), 1: set()}
            for sig, owner in jaccard.signatures(found, np.array([0, size, 2 * size])):
                for s, o in zip(sig.tolist(), owner.tolist(), strict=True):
                    seen[o].add(s)
            assert seen[0] & seen[1]


def test_bitmaps_never_refuse_similar_sets():
    rng = np.random.default_rng(3)
    for size in (5, 64, 65, 300, 2000):
        base = np.sort(rng.integers(0, 2**63, size).astype(np.uint64))
        longer = np.sort(np.concatenate([base, rng.integers(0, 2**63, size // 4).astype(np.uint64)]))
        found, at = np.concatenate([base, longer]), np.array([0, size, size + len(longer)])
        maps = jaccard._fold(jaccard.parity_maps(found, at))
        assert jaccard._may(maps, np.diff(at), 0, np.array([1])).all()


def test_shingle_sets_by_hand():
    texts = ["a b c d e f", "A B  C\td\ne f", "a b", None, "", "a b c d e a b c d e"]
    found, at = shingle_sets(pa.array(texts))
    assert np.diff(at).tolist() == [len(shingles(t)) for t in texts]
    assert found[at[0] : at[1]].tolist() == found[at[1] : at[2]].tolist()


def test_long_chain_of_pairs(spark):
    pairs = [(k, k + 1) for k in range(300)] + [(1000, 1001), (1001, 1000), (5, 5)]
    got = dict(components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect())
    assert got == {**dict.fromkeys(range(301), 0), 1000: 1000, 1001: 1000}


def test_more_tasks_than_the_setting(documents, rows, monkeypatch):
    """How many tasks the signatures are dealt to does not show in the result."""
    monkeypatch.setattr(jaccard, "DOCS_A_TASK", 1)
    monkeypatch.setattr(jaccard, "LEAST_BUCKETS", 1)
    assert run(documents) == brute(rows)

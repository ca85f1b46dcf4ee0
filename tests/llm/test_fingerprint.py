import hashlib
import math
import random

import numpy as np

from conftest import as_documents
from weektide.llm import fingerprint as fp


def brute_levels(raw):
    out, full = [], fp.SIZE * 6 * (1 << 20)
    for k in range(len(raw) - fp.SIZE + 1):
        counts = np.bincount(raw[k : k + fp.SIZE])
        total = sum(round(c * math.log2(c) * (1 << 20)) for c in counts.tolist() if c)
        out.append((full - total) * fp.LEVELS // full)
    return out


def test_entropies_by_counting():
    rng = np.random.default_rng(1)
    for letters in (1, 2, 20, 256):
        for size in (0, 63, 64, 65, 700):
            raw = rng.integers(0, letters, size).astype(np.uint8)
            assert fp.entropies(raw).tolist() == brute_levels(raw)


def test_selection_by_brute_force():
    rng = np.random.default_rng(2)
    rank = fp.ranks(rng.integers(0, 50, fp.LEVELS + 1))
    for size in (1, 30, 64, 200):
        levels = rng.integers(0, 40, size)
        wins = np.zeros(size, int)
        reach = min(fp.SIZE, size)
        for k in range(size - reach + 1):
            run = rank[levels[k : k + reach]]
            wins[k + int(run.argmin())] += 1
        need = fp.POPULAR if size >= fp.SIZE else 1
        want = [k for k in range(size) if wins[k] >= need and levels[k] > 0]
        assert fp.select(levels, rank).tolist() == want


def test_likeness():
    rng = random.Random(3)
    rank = fp.ranks(np.arange(fp.LEVELS + 1)[::-1].copy())

    def of(text):
        raw = np.frombuffer(text.encode(), np.uint8)
        return fp.digest(raw, fp.entropies(raw), rank)

    def words(n):
        return " ".join("".join(rng.choice("abcdefghijklm") for _ in range(5)) for _ in range(n))

    a, b = words(3000), words(3000)
    assert len(of(a)[0]) > 1
    assert fp.likeness(of(a), of(a)) == 1 and fp.likeness(of(""), of("")) == 1
    assert fp.likeness(of(a), of("")) == 0 and fp.likeness(of(a), of(b)) < 0.15
    near = fp.likeness(of(a), of(a[: len(a) // 2] + b[len(b) // 2 :]))
    assert 0.3 < near < 0.8 and fp.likeness(of(a), of(a[: len(a) // 2])) > 0.8
    assert fp.likeness(of(a), of(b)) == fp.likeness(of(b), of(a))


def check(got, rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for k, (doc, text, _) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        edited = fp.edit(text, following)
        want.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == sorted(want, key=str)


def test_all_documents(documents, rows, no_documents, spark):
    got = fp.fingerprints(documents).collect()
    check(got, rows)
    texts = {str((r.doc_id, r.n_chars)): r.fingerprint for r in got}
    assert texts[str((6, len(rows[6][1])))] == texts[str((7, len(rows[7][1])))]
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fp.fingerprints(no_documents).collect() == []
    one = fp.fingerprints(as_documents(spark, [(5, "abc " * 50, None)])).collect()
    assert len(one) == 1 and one[0].near_next == 1


def test_edited_digest_equals_that_of_the_edited_text(documents, rows):
    got = {r.doc_id: r for r in fp.fingerprints(documents).collect() if r.doc_id is not None}
    rank = fp.ranks(fp.learn_counts(documents, "text"))
    for doc, after in [(9, 8), (11, 10), (17, 16), (16, 15), (8, 7)]:
        raw = np.frombuffer(fp.edit(rows[doc][1], rows[after][1]).encode(), np.uint8)
        assert got[doc].edited_fingerprint == fp.as_text(fp.digest(raw, fp.entropies(raw), rank))

import functools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from weektide.llm import packing
from weektide.llm.packing import CAPACITY, WordIds, best_multiset, pack, plan

PATH = public_tokenizers.path("byte_bpe_50k.json")


@functools.cache
def tokenizer():
    return Tokenizer.from_file(PATH)


def reference_ids(text):
    return tokenizer().encode(text or "", add_special_tokens=False).ids + [1]


def check_pieces(got, texts, capacity=CAPACITY):
    """Every id in exactly one piece, sequences without gaps, hardly any padding."""
    want = {}
    for doc, text in texts:
        want.setdefault(doc, []).append(np.array(reference_ids(text), "<u4"))
    by_doc = {}
    for p in got:
        by_doc.setdefault(p.doc_id, []).append(p)
    assert set(by_doc) == set(want)
    for doc, arrays in want.items():
        assert sum(p.length for p in by_doc[doc]) == sum(map(len, arrays))
        for p in by_doc[doc]:
            sums = {
                zlib.crc32(a[p.start : p.start + p.length].tobytes())
                for a in arrays if len(a) == p.doc_tokens
            }
            assert p.ids_crc32 in sums
    sequences = {}
    for p in got:
        sequences.setdefault(p.sequence_id, []).append(p)
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == capacity or at & (at - 1) == 0


def test_all_pieces(documents, rows):
    got = pack(documents, "doc_id", "text", PATH).collect()
    check_pieces(got, [(i, t) for i, t, _ in rows])


def test_no_documents(no_documents):
    assert pack(no_documents, "doc_id", "text", PATH).collect() == []


def test_words_have_the_tokenizers_ids():
    rng = random.Random(3)
    signs = "ab z'sé,.1 \n\t   xЖ日😀_-'ll'  <|endoftext|>"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts = [t for t in texts if "<|endoftext|>" not in t]
    encode = WordIds(PATH, remembered=200)
    for at in range(0, len(texts), 100):
        for text, packed in zip(texts[at : at + 100], encode(texts[at : at + 100]), strict=True):
            assert np.frombuffer(packed, "<u4").tolist() == reference_ids(text)[:-1], repr(text)


def test_random_signs_in_long_slices():
    """White space and letters of all widths, special tokens, empty texts, few remembered words."""
    rng = random.Random(4)
    signs = "abé Àÿ×÷µ1.'\n\t\x1c\x85\xa0\u1680\u2003\u2028\u202f\u3000Ж日😀ª€\0"
    texts = ["".join(rng.choice(signs) for _ in range(rng.choice([0, 1, 2, 30, 300]))) for _ in range(4000)]
    texts += ["a<|endoftext|>b c<|endoftext|>", " <|endoftext|> x", "x" * 10_000, " " * 3000 + "end"]
    for remembered in (300, 400_000):
        encode = WordIds(PATH, remembered=remembered)
        for at in range(0, len(texts), 500):
            for text, packed in zip(texts[at : at + 500], encode(texts[at : at + 500]), strict=True):
                assert np.frombuffer(packed, "<u4").tolist() == reference_ids(text)[:-1], repr(text)


def test_words_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(packing, "word_hashes", lambda raw, begin, end: (end - begin).astype(np.uint64))
    texts = ["one two six", "ten 12,five", "", "one"]
    for text, packed in zip(texts, WordIds(PATH)(texts), strict=True):
        assert np.frombuffer(packed, "<u4").tolist() == reference_ids(text)[:-1]


def brute_best(counts, capacity):
    reach = {0}
    for n, c in counts.items():
        reach = {r + n * k for r in reach for k in range(c + 1) if r + n * k <= capacity}
    return max(reach)


def test_multiset_fills_best():
    rng = random.Random(5)
    for _ in range(200):
        counts = {rng.randint(1, 40): rng.randint(1, 4) for _ in range(rng.randint(1, 6))}
        chosen = best_multiset(counts, 50)
        assert all(c <= counts[n] for n, c in chosen)
        longest = max(counts)
        rest = dict(counts) | {longest: counts[longest] - 1}
        assert sum(n * c for n, c in chosen) == longest + brute_best(rest, 50 - longest)


@pytest.mark.parametrize("counts", [
    {}, {1: 1}, {1500: 1000}, {2047: 3}, {700: 5, 3: 1000, 2000: 77},
    {n: 1 + n % 5 for n in range(1, 2048, 7)},
])
def test_plan_places_every_id_once(counts):
    rows, sequences = plan(counts)
    placed, filled = {}, {}
    for n, rank, times, start, part, sequence, at in rows:
        for k in range(times):
            placed.setdefault((n, rank + k), []).append((start, part))
            filled.setdefault(sequence + k, []).append((at, part))
    assert len(placed) == sum(counts.values()) and len(filled) == sequences
    for (n, rank), parts in placed.items():
        assert rank < counts[n] and sum(p for _, p in parts) == n
        assert all(a + p == b for (a, p), (b, _) in zip(sorted(parts), sorted(parts)[1:]))
    padded = [s for s in (sum(p for _, p in f) for f in filled.values()) if s & (s - 1)]
    assert not padded

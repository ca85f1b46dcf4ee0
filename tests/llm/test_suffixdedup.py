import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from conftest import as_documents
from weektide.llm import suffixdedup as sd
from weektide.llm.suffixes import suffix_order


def brute(rows):
    """Equal rows count once; rows of one id are left out of what is compared."""
    seen, out = {}, []
    for doc, text, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (text or "").encode()
        gone = bytearray(len(raw))
        for k in range(len(raw) - sd.LENGTH + 1):
            window = raw[k : k + sd.LENGTH]
            if seen.setdefault(window, (doc, k)) != (doc, k):
                gone[k : k + sd.LENGTH] = b"\1" * sd.LENGTH
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        runs = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((doc, len(raw), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def run(df):
    return sorted((tuple(r) for r in sd.remove_repeats(df).collect()), key=str)


def shared_rows():
    rng = random.Random(4)

    def text(n):
        return " ".join("".join(rng.choice("abcdé") for _ in range(4)) for _ in range(n))

    passage = text(40)
    rows = [(k, text(30) + passage + text(30), None) for k in range(40)]
    rows += [(50, "ab" * 300, None), (51, "x" * 400, None), (52, passage * 3, None), (53, "x" * 99, None)]
    return rows + [(60 + k, rows[0][1], None) for k in range(5)] + [(60, rows[0][1], None)]


@pytest.mark.parametrize("hot", [sd.HOT, 3])
def test_shared_passages(spark, monkeypatch, hot):
    monkeypatch.setattr(sd, "HOT", hot)
    rows = shared_rows()
    assert run(as_documents(spark, rows)) == brute(rows)


def alone(text):
    """Whether the window at byte 1 is a segment of its own."""
    raw = np.frombuffer(text.encode(), np.uint8)
    begin, count, *_ = sd.segments(raw, np.array([0, len(raw)]))
    return (1, 1) in zip(begin.tolist(), count.tolist(), strict=True)


def single_rows():
    """A passage of one window, which is a segment of its own in the first and last document only."""
    rng = random.Random(9)
    signs = "".join(map(chr, range(33, 127)))
    while True:
        passage = "".join(rng.choices(signs, k=sd.LENGTH))
        around = [(a, b) for a in signs for b in signs if alone(a + passage + b)]
        if around:
            break
    a, b = around[0]
    others = [c for c in signs if not alone(a + passage + c) and not alone(c + passage + b)]

    def text(n):
        return "".join(rng.choices(signs, k=n))

    rows = [(0, text(150) + a + passage + b + text(150), None)]
    for k in range(1, 9):
        c = rng.choice(others)
        rows.append((k, text(150) + c + passage + c + text(150), None))
    return [*rows, (9, text(150) + a + passage + b + text(150), None)]


@pytest.mark.parametrize("last", [False, True])
def test_single_window_of_a_hot_key(spark, monkeypatch, last):
    monkeypatch.setattr(sd, "HOT", 3)
    rows = single_rows()[1:] if last else single_rows()
    want = brute(rows)
    assert sum(r[2] >= sd.LENGTH for r in want) == len(rows) - 1
    assert run(as_documents(spark, rows)) == want


def test_all_documents(documents, rows):
    # The two rows without an id differ, and their order is that of a hash.
    got = run(documents)
    assert len(got) == len(rows)
    assert [r for r in got if r[0] is not None and r[0] != 99] == [
        r for r in brute([x for x in rows if x[0] is not None or x[1]]) if r[0] is not None and r[0] != 99
    ]


def test_no_documents(no_documents):
    assert run(no_documents) == []


def test_suffix_order_against_sorting():
    rng = np.random.default_rng(0)
    for trial in range(60):
        sizes = rng.integers(0, 25, rng.integers(1, 10))
        strings = [bytes(rng.integers(0, 2 + 200 * (trial % 2), n).astype(np.uint8)) for n in sizes]
        if not sum(sizes):
            continue
        ends = np.cumsum(sizes)
        place, common = suffix_order(np.frombuffer(b"".join(strings), np.uint8), ends, 10)
        owner = np.searchsorted(ends, place, "right")
        got = [strings[o][a - (ends[o] - sizes[o]) :] for o, a in zip(owner, place, strict=True)]
        assert got == sorted(s[k:] for s in strings for k in range(len(s)))
        for k in range(1, len(got)):
            shared = 0
            while shared < min(len(got[k]), len(got[k - 1]), 10) and got[k][shared] == got[k - 1][shared]:
                shared += 1
            assert common[k] == shared


def test_more_tasks_than_the_setting(spark, monkeypatch):
    """How many tasks the segments are dealt to does not show in the result."""
    monkeypatch.setattr(sd, "DOCS_A_TASK", 2)
    rows = shared_rows()
    assert run(as_documents(spark, rows)) == brute(rows)


def settled(rows):
    """What becomes of the segments of all rows, and how many segments there are."""
    raw, at = sd.utf8(pa.array([text for _, text, _ in rows]))
    begin, *rest = sd.segments(raw, at)
    owner = np.searchsorted(at, begin, "right") - 1
    docs = np.array([[doc, 0] for doc, *_ in rows])
    parcel = sd._Parcel(1)
    parcel.add(docs, owner, begin - at[owner], *rest)
    return sd._settle(pa.Table.from_batches(list(parcel.flush()))), len(begin)


def test_short_passages_are_not_fetched():
    """Segments that share their key's gram but no window stay where they are."""
    rng = random.Random(2)
    signs = "".join(map(chr, range(33, 127)))

    def text(n):
        return "".join(rng.choices(signs, k=n))

    short, long = text(60), text(sd.LENGTH)
    apart, _ = settled([(k, text(200) + short + text(200), None) for k in range(300)])
    assert len(apart) < 30  # hashes of 16 bits
    shared, _ = settled([(k, text(200) + long + text(200), None) for k in range(300)])
    assert len(shared) >= 300


def test_windows_at_every_place_of_the_gram(spark):
    """Passages of one window, around which nothing is equal."""
    rng = random.Random(5)
    signs = "".join(map(chr, range(33, 127)))

    def text(n):
        return "".join(rng.choices(signs, k=n))

    passages = [text(sd.LENGTH) for _ in range(400)]
    rows = [
        (doc, text(20) + "".join(p + text(rng.randint(1, 60)) for p in rng.sample(passages, 200)), None)
        for doc in range(4)
    ]
    want = brute(rows)
    assert sum(r[2] for r in want) >= 200 * sd.LENGTH
    assert run(as_documents(spark, rows)) == want


def test_a_gram_in_several_places(spark):
    """Windows that hold the second of two equal grams in one text, and the only one in another."""
    rng = random.Random(6)
    signs = "".join(map(chr, range(33, 127)))

    def text(n):
        return "".join(rng.choices(signs, k=n))

    def low(gram):
        return sd.rolling(np.frombuffer(gram.encode(), np.uint8))(np.array([0]), sd.GRAM)[0]

    rows = []
    for k in range(10):
        gram = min((text(sd.GRAM) for _ in range(2000)), key=low)
        shared = gram + text(10) + gram + text(60)
        rows.append((2 * k, text(150) + shared + text(150), None))
        rows.append((2 * k + 1, text(150) + "\n" + shared[1 : 1 + sd.LENGTH] + text(150), None))
    want = brute(rows)
    assert sum(r[2] == sd.LENGTH for r in want) == 10
    assert run(as_documents(spark, rows)) == want

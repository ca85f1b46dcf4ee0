"""Secret scanning against a plain version."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from weektide.llm import secretscan as S
from weektide.llm.q_secretscan import digest

PLAIN = {
    "assign": re.compile(
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}
RUN = re.compile(r"[A-Za-z0-9+/_=-]+")
UUID = re.compile("[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")


def high(window):
    """Whether a window counts as high, from its counts anew."""
    bits = math.log2(len(window)) - sum(
        round(n * math.log2(n) * S.UNIT) for n in Counter(window).values()
    ) / S.UNIT / len(window)
    up, low, dig = (sum(a <= c <= z for c in window) for a, z in ("AZ", "az", "09"))
    sign = len(window) - up - low - dig
    if all(c in "0123456789abcdefABCDEF" for c in window):
        return dig >= 3 and up + low >= 3 and bits >= 3.0
    if not sign and not (up and low):
        return dig >= 3 and up + low >= 3 and bits >= 3.6
    return sign <= 2 and min(dig, up, low) >= 2 and bits >= 3.9


def plain(text):
    text, out = text or "", []
    for rank, (kind, pattern) in enumerate(PLAIN.items()):
        for m in pattern.finditer(text):
            least = {"assign": 6, "access": 20, "hex": 24}[kind]
            if len(m.group(2) if kind == "assign" else m.group()) >= least:
                out.append((m.start(), rank, kind, m.end()))
    for m in RUN.finditer(text):
        if UUID.fullmatch(m.group()):
            continue
        spans = []
        for p in range(len(m.group()) - S.WINDOW + 1):
            if high(m.group()[p : p + S.WINDOW]):
                if spans and p <= spans[-1][1]:
                    spans[-1][1] = p + S.WINDOW
                else:
                    spans.append([p, p + S.WINDOW])
        for s, e in spans:
            if not any(w in m.group()[s:e].lower() for w in S.ALLOWED_WORDS):
                out.append((m.start() + s, 3, "entropy", m.start() + e))
    return [(k, s, e, text[s:e]) for s, _, k, e in sorted(out)]


def check(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.spans] for r in S.scan(docs, "doc_id", "text").collect()}
    for i, text in enumerate(texts):
        assert got[i] == plain(text), text if text is None else text[:300]
    return got


def rand(rng, signs, n):
    return "".join(rng.choice(signs) for _ in range(n))


KINDS = [
    "0123456789abcdef", "0123456789ABCDEF", "abcdefghijklmnopqrstuvwxyz0123456789",
    S.ALPHABET, S.ALPHABET[:62], "0123456789", "abcdefgh", "aA1",
]


def test_planted(spark):
    rng = random.Random(1)
    texts = []
    for k in range(120):
        parts = []
        for _ in range(rng.randint(1, 6)):
            secret = rand(rng, rng.choice(KINDS), rng.randint(3, 70))
            lead = rng.choice([
                "", "token = ", 'Api_Key:"', "apikey='", "PASSWORD=", "pAsswd : ", "secret\" : ", "AKIA", "é😀 ", "x",
                "token:token:", "ſecret=", "toKen=",
            ])
            parts.append(lead + secret + rng.choice(["", '"', "."]))
        texts.append(rng.choice([" ", "\n", "ü, "]).join(parts))
    got = check(spark, texts)
    assert {k for spans in got.values() for k, *_ in spans} == set(S.KINDS)


def test_edges(spark):
    texts = [
        None, "", " ", "token=abc", "token=abcdef", "secret=token=abcdef", "token:token:abcdefgh",
        "AKIA" + "A" * 15, "AKIA" + "A" * 16, "AKIAAKIA" + "B" * 16, "a" * 23, "a" * 24, "\n" + "f" * 30 + "g",
        "123e4567-e89b-12d3-a456-426614174000", "id 123e4567-e89b-12d3-a456-426614174000x",
        "Zq8EXAMPLEk3Pw9Ls2Vn7Tb4", "Zq8Fj5Xk3Pw9Ls2Vn7Tb4", "Batch-2024-Report-Final-Version",
        "einheitverererbeeinheitkeiter", "日本語" * 40 + " token='Zq8Fj5Xk3'", "\0\1 token=abcdef\0",
    ]
    got = check(spark, texts)
    assert [k for k, *_ in got[16]] == ["entropy"] and not got[15] and not got[13]


def test_long_candidates_cross_blocks(spark):
    """Spans go on over blocks and begin in any of them; a text is never cut."""
    rng = random.Random(2)
    dull = "ab" * 6000
    texts = [
        rand(rng, S.ALPHABET[:62], 13_000),
        dull[: S._BLOCK - 7] + rand(rng, S.ALPHABET[:62], 30) + dull,
        "".join(rand(rng, KINDS[2], 25) + "-" * 30 for _ in range(500)),
        " ".join(f"token={rand(rng, KINDS[0], 40)}" for _ in range(1500)),
    ]
    got = check(spark, texts)
    assert got[0][-1][2] > 12_500 and got[1] and len(got[3]) >= 3000


def test_rows_of_any_kind(spark, documents, rows, no_documents):
    got = S.scan(documents, "doc_id", "text").collect()
    assert len(got) == len(rows)
    key = lambda r: (r[0] is None, r[0] or 0, str(r[1]))
    assert sorted([(r.doc_id, [tuple(s) for s in r.spans]) for r in got], key=key) == sorted(
        [(i, plain(t)) for i, t, _ in rows], key=key
    )
    assert digest(S.scan(no_documents, "doc_id", "text")).collect() == []


def test_digest(spark):
    docs = spark.createDataFrame([(1, "token=abcdef " + "ab1" * 9), (2, None)], "doc_id long, text string")
    one, two = digest(S.scan(docs, "doc_id", "text")).orderBy("doc_id").collect()
    assert (one.n_assign, one.n_access, one.n_hex, one.spans) == (1, 0, 1, "assign:0:12,hex:13:40")
    assert one.base_sha256 == hashlib.sha256(one.spans.encode()).hexdigest()
    assert (two.spans, two.base_sha256) == ("", hashlib.sha256(b"").hexdigest())


def test_allow_list_is_a_parameter(spark):
    docs = spark.createDataFrame([(1, "Zq8Fj5Xk3Pw9Ls2Vn7Tb4")], "doc_id long, text string")
    assert not S.scan(docs, "doc_id", "text", allowed_words=["FJ5x"]).first().spans
    assert not S.scan(docs, "doc_id", "text", allowed_shapes=["Zq8.*"], allowed_words=[]).first().spans
    with pytest.raises(ValueError, match="window"):
        S.scan(docs, "doc_id", "text", window=32)


def test_no_python_in_the_plan(spark, documents):
    found = digest(S.scan(documents, "doc_id", "text").where(F.size("spans") >= 0))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

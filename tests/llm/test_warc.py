import base64
import gzip
import hashlib

from pyspark.sql import functions as F

from weektide.llm import warc

PAGES = [
    (1, "http://a/", "<p>one</p>"), (2, "http://b/", "<p>one</p>"), (5, None, "<p>one</p>"),
    (3, "http://c/\r\nX: y", ""), (4, "http://d/", None), (6, "u", "é" * 5000),
    (7, "u", "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n"),
    (5, None, "<p>one</p>"), (None, "u", "alone"), (8, "u", "\x1f\x8b\x08 \x00"),
]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def pages(spark, rows):
    schema = "page_id bigint, url string, html string, digest string, kept bigint, n bigint"
    return spark.createDataFrame([(*r, "x", 1, 1) for r in rows], schema)


def round_trip(spark, df, path, least=0, size=warc.ARCHIVE_BYTES):
    plan = warc.plan_records(df, "page_id", "url", "html", least)
    warc.write_archives(plan, path, size)
    return warc.read_archives(spark, path).withColumn("id", warc.page_number(F.col("record_id")))


def test_round_trip(spark, tmp_path):
    got = round_trip(spark, pages(spark, PAGES), f"file://{tmp_path}/w", size=1000).collect()
    assert len(got) == len(PAGES) and all(r.problem is None for r in got)
    largest = {}
    for page, _, html in PAGES:
        if page is not None:
            largest[html or ""] = max(largest.get(html or "", -1), page)
    want = sorted(
        (str(p), digest(h), "response" if p is None or p == largest[h or ""] else "revisit")
        for p, _, h in PAGES
    )
    assert sorted((str(r.id), r.payload_digest, r.record_type) for r in got) == want
    for r in got:
        if r.record_type == "response":
            assert digest(bytes(r.payload).decode()) == r.payload_digest
        else:
            assert r.payload is None and r.http_length is not None
            assert r.refers_to == f"<urn:x-page:{5 if r.id < 3 else 4}>"


def test_small_payloads_may_repeat(spark, tmp_path):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")]
    got = round_trip(spark, pages(spark, rows), f"file://{tmp_path}/w", least=3).collect()
    assert sorted((r.id, r.record_type) for r in got) == [
        (1, "response"), (2, "response"), (3, "revisit"), (4, "response")
    ]


def test_no_pages(spark, tmp_path):
    assert round_trip(spark, pages(spark, []), f"file://{tmp_path}/w").count() == 0


def records(n):
    return [
        warc.record_bytes(k, "u", f"page {k}".encode() * 50, digest(f"page {k}" * 50), "response", None, "d")
        for k in range(n)
    ]


def found(data):
    rows = list(warc.salvage(data))
    assert sum(r["length"] for r in rows) <= len(data)
    ids = [r["record_id"] for r in rows if r["problem"] is None]
    return ids, [(r["offset"], r["length"]) for r in rows if r["problem"]]


def test_broken_member_is_quarantined():
    members = [gzip.compress(r) for r in records(5)]
    hurt = bytearray(members[2])
    hurt[len(hurt) // 2] ^= 0xFF
    ids, gaps = found(b"".join(members[:2]) + bytes(hurt) + b"".join(members[3:]))
    assert ids == [f"<urn:x-page:{k}>" for k in (0, 1, 3, 4)]
    assert gaps == [(len(members[0]) + len(members[1]), len(hurt))]


def test_plain_records_and_junk():
    raw = records(4)
    wrong = raw[1].replace(b"page 1", b"page X", 1)  # the digest tells
    data = b"junk" + raw[0] + wrong + raw[2] + raw[3][:-9]
    ids, gaps = found(data)
    assert ids == ["<urn:x-page:0>", "<urn:x-page:2>"]
    assert gaps == [(0, 4), (4 + len(raw[0]), len(wrong)), (len(data) - len(raw[3]) + 9, len(raw[3]) - 9)]


def test_cut_member_and_empty_file():
    member = gzip.compress(records(1)[0])
    assert found(member[:-3]) == ([], [(0, len(member) - 3)])
    assert found(b"") == ([], []) and found(b"\0\0") == ([], [])


def test_length_header_lies():
    raw = records(3)
    raw[1] = raw[1].replace(b"Content-Length: ", b"Content-Length: 9", 1)
    ids, gaps = found(b"".join(raw))
    assert ids == ["<urn:x-page:0>", "<urn:x-page:2>"] and len(gaps) == 1


def test_one_bad_record_of_a_member_costs_one_record():
    raw = records(5)
    wrong = raw[2].replace(b"page 2", b"page X", 1)
    member = gzip.compress(b"".join([*raw[:2], wrong, *raw[3:]]))
    rows = list(warc.salvage(member))
    assert [r.get("record_id") for r in rows] == ["<urn:x-page:0>", "<urn:x-page:1>", None, "<urn:x-page:3>", "<urn:x-page:4>"]
    gap = rows[2]
    assert gap["problem"] and (gap["inner_offset"], gap["inner_length"]) == (len(raw[0] + raw[1]), len(wrong))
    junk = gzip.compress(raw[0] + b"junk" + raw[1])
    ids = [r.get("record_id") for r in warc.salvage(junk + gzip.compress(raw[2]))]
    assert ids == ["<urn:x-page:0>", None, "<urn:x-page:1>", "<urn:x-page:2>"]


def test_a_cut_member_keeps_what_came_before():
    raw = records(5)
    for level in (0, 6):
        member = gzip.compress(b"".join(raw), level)
        after = gzip.compress(raw[0])
        ids, gaps = found(member[:-20] + after)
        assert ids[-1] == "<urn:x-page:0>" and gaps == [(0, len(member) - 20)]
        assert ids[:-1] == [f"<urn:x-page:{k}>" for k in range(len(ids) - 1)] and len(ids) >= 4


def test_digests_of_other_kinds():
    payload = b"some payload"
    sha1, sha256 = hashlib.sha1(payload), hashlib.sha256(payload)
    good = [
        "sha1:" + base64.b32encode(sha1.digest()).decode(), "sha1:" + sha1.hexdigest(), "SHA1:" + sha1.hexdigest().upper(),
        "sha256:" + sha256.hexdigest(), "sha-256:" + base64.b32encode(sha256.digest()).decode(),
        "md5:" + hashlib.md5(payload).hexdigest(), "blake3:00ff", "sha256:=?=", "xxh:1",
    ]
    bad = ["sha1:" + hashlib.sha1(b"x").hexdigest(), "sha256:" + "0" * 64, "md5:" + "a" * 32]
    for text, whole in [(g, True) for g in good] + [(b, False) for b in bad]:
        raw = warc.record_bytes(1, "u", payload, "D", "response", None, "d").replace(b"sha1:D", text.encode())
        ids, gaps = found(raw)
        assert (len(ids), len(gaps)) == ((1, 0) if whole else (0, 1)), text

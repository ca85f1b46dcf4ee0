"""WARC archives: a writer with revisit records and a reader that salvages damaged files.

The writer packs records, each a gzip member of its own, into archives of bounded
size.  The reader walks an archive member by member (or, in plain archives, record
by record).  Where a check fails it searches for the next position at which a whole
valid record starts, goes on from there, and reports the bytes in between as a gap; it
does so inside of members as well, also of damaged ones as far as they can be inflated.

Defined results: a NULL payload is an empty one, a NULL url leaves the target out, a
NULL id gives an empty record id which reads back as NULL.  Rows that repeat the
largest id of a payload are all ``response``.  No rows give an empty folder and no
records.  Other columns of the input are not looked at.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weektide.llm.store import sent_if_few

#: Bytes after which an archive is closed; one larger record still makes one archive.
ARCHIVE_BYTES = 16 << 20

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_ID = "<urn:x-page:{}>"

RECORDS = (
    "path string, offset bigint, length bigint, problem string, record_id string, "
    "record_type string, target_uri string, payload_digest string, refers_to string, "
    "http_length bigint, payload binary, inner_offset bigint, inner_length bigint"
)
_RECORDS = pa.schema([
    ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
    ("problem", pa.string()), ("record_id", pa.string()), ("record_type", pa.string()),
    ("target_uri", pa.string()), ("payload_digest", pa.string()),
    ("refers_to", pa.string()), ("http_length", pa.int64()), ("payload", pa.binary()),
    ("inner_offset", pa.int64()), ("inner_length", pa.int64()),
])


def sha1_base32(payload: Column) -> Column:
    """Upper-case base32 SHA-1 of a binary column: 20 bits of the hex digest at a time."""
    digest = F.sha1(payload)
    letters = []
    for start in range(1, 41, 5):
        bits = F.conv(F.substring(digest, start, 5), 16, 10).cast("int")
        for shift in (15, 10, 5, 0):
            five = F.shiftright(bits, shift).bitwiseAND(31)
            letters.append(F.substring(F.lit(_BASE32), five + 1, F.lit(1)))
    return F.concat(*letters)


def plan_records(
    pages: DataFrame, id_col: str, url_col: str, payload_col: str, least_bytes: int = 0
) -> DataFrame:
    """Rows ``id, url, payload, digest, record_type, refers_to`` of the records to write.

    Among equal payloads of at least ``least_bytes`` bytes the one with the largest id
    is the response and the others revisit it.  Only (digest, id) pairs are grouped, and
    only digests that occur more than once come back.  If they are few, they are sent to
    the payloads; beyond that the join shuffles payloads by digest.
    """
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", sha1_base32(F.col("payload")))
    copies = (
        rows.where(F.length("payload") >= least_bytes).groupBy("digest")
        .agg(F.count("*").alias("n"), F.max("id").alias("kept"))
        .where("n > 1 and kept is not null").select("digest", "kept")
    )
    copies = sent_if_few(copies, "copies")
    revisits = F.expr("kept is not null and (id is null or id < kept)")
    return rows.join(copies, "digest", "left").select(
        "id", "url", "payload", "digest",
        F.when(revisits, "revisit").otherwise("response").alias("record_type"),
        F.when(revisits, F.col("kept")).alias("refers_to"),
    )


def record_bytes(
    record_id: int | None, url: str | None, payload: bytes, digest: str,
    record_type: str, refers_to: int | None, date: str,
) -> bytes:
    """One record, from version line to closing line breaks."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if record_type == "revisit" else http + payload
    lines = [
        "WARC/1.1", f"WARC-Type: {record_type}",
        "WARC-Record-ID: " + _ID.format("" if record_id is None else record_id),
        f"WARC-Date: {date}",
    ]
    if url is not None:
        target = url.replace("\r", "%0D").replace("\n", "%0A")
        lines.append(f"WARC-Target-URI: {target}")
    lines.append(f"WARC-Payload-Digest: sha1:{digest}")
    if record_type == "revisit":
        lines.append(
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        )
        lines.append("WARC-Refers-To: " + _ID.format(refers_to))
    lines.append("Content-Type: application/http;msgtype=response")
    lines.append(f"Content-Length: {len(block)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(
    records: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write planned records below ``path``: one archive per output file.

    A task gathers members up to ``archive_bytes`` and hands them on as one row, which
    Spark's text writer puts into one file as it is.  The writer ends a row with one
    separator; a zero byte after the last member is padding that gzip readers skip.
    """

    def archives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        members, size = [], 0
        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            for k in range(batch.num_rows):
                raw = record_bytes(*(c[k].as_py() for c in columns), date)
                deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
                members.append(deflate.compress(raw) + deflate.flush())
                size += len(members[-1])
                if size >= archive_bytes:
                    yield pa.record_batch([pa.array([b"".join(members)], pa.binary())], ["value"])
                    members, size = [], 0
        if members:
            yield pa.record_batch([pa.array([b"".join(members)], pa.binary())], ["value"])

    columns = ["id", "url", "payload", "digest", "record_type", "refers_to"]
    files = records.select(*columns).mapInArrow(archives, "value binary")
    (
        files.select(F.col("value").cast("string"))
        .write.option("lineSep", "\0").option("maxRecordsPerFile", 1).text(path)
    )


def _parse(data: bytes, at: int) -> tuple[dict, int]:
    """The record at ``at`` and where it ends; ValueError if a check fails."""
    if not _VERSION.match(data, at):
        raise ValueError("no version line")
    end = data.find(b"\r\n\r\n", at)
    if end < 0:
        raise ValueError("no end of header")
    fields = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ValueError("broken header line")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch("[0-9]+", fields.get("content-length", "")):
        raise ValueError("no content length")
    start, size = end + 4, int(fields["content-length"])
    if data[start + size : start + size + 4] != b"\r\n\r\n":
        raise ValueError("block cut short or too long")
    payload, http_length = data[start : start + size], None
    if fields.get("content-type", "").startswith("application/http"):
        head, blank, payload = payload.partition(b"\r\n\r\n")
        if not blank:
            raise ValueError("no end of HTTP header")
        found = re.search(rb"(?im)^content-length:[ \t]*([0-9]+)", head)
        http_length = int(found[1]) if found else None
    kind = fields.get("warc-type")
    digest = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind != "revisit" and digest and not _agrees(digest, payload):
        raise ValueError("payload digest differs")
    return {
        "record_id": fields.get("warc-record-id"), "record_type": kind,
        "target_uri": fields.get("warc-target-uri"), "payload_digest": digest or None,
        "refers_to": fields.get("warc-refers-to"), "http_length": http_length,
        "payload": None if kind == "revisit" else payload,
    }, start + size + 4


def _agrees(digest: str, payload: bytes) -> bool:
    """Whether a payload has that digest; one of an unknown algorithm or encoding is not checked.

    Without a label it is SHA-1.  Hexadecimal and base32 are told apart by their length.
    """
    label, colon, value = digest.rpartition(":")
    label = label.lower().replace("-", "") if colon else "sha1"
    if label not in ("md5", "sha1", "sha256", "sha384", "sha512"):
        return True
    made = hashlib.new(label, payload).digest()
    if len(value) == 2 * len(made):
        return value.lower() == made.hex()
    base32 = base64.b32encode(made).decode()
    if len(value.rstrip("=")) == len(base32.rstrip("=")):
        return value.upper().rstrip("=") == base32.rstrip("=")
    return True


def _inflated(data: bytes, pos: int) -> tuple[bytes, int, str | None]:
    """What can be inflated of the member at ``pos``, where that ends, and what is wrong with it."""
    inflate, parts, fed, view = zlib.decompressobj(31), [], pos, memoryview(data)
    while not inflate.eof and fed < len(data):
        before = inflate.copy()
        try:
            parts.append(inflate.decompress(view[fed : fed + _STEP]))
            fed = min(fed + _STEP, len(data))
        except zlib.error as error:
            # Byte by byte up to the damage.
            try:
                while fed < len(data):
                    parts.append(before.decompress(view[fed : fed + 1]))
                    fed += 1
            except zlib.error:
                pass
            return b"".join(parts), fed, str(error)
    if not inflate.eof:
        return b"".join(parts), len(data), "member cut short"
    return b"".join(parts), fed - len(inflate.unused_data), None


def _plain(data: bytes) -> Iterator[tuple[int, int, dict | None, str | None]]:
    """Begin and end of the records and gaps of plain bytes, with the record or what is wrong."""
    pos, bad, why = 0, None, None
    while pos < len(data):
        if bad is None:
            pos = _PADDING.match(data, pos).end()
            if pos == len(data):
                break
        try:
            record, end = _parse(data, pos)
        except ValueError as error:
            if bad is None:
                bad, why = pos, str(error)
            found = _VERSION.search(data, pos + 1)
            pos = found.start() if found else len(data)
            continue
        if bad is not None:
            yield bad, pos, None, why
            bad = None
        yield pos, end, record, None
        pos = end
    if bad is not None:
        yield bad, len(data), None, why


#: Bytes given to the decompressor at a time.
_STEP = 1 << 14
_VERSION = re.compile(rb"WARC/1\.\d\r\n")
_MEMBER = re.compile(rb"\x1f\x8b\x08")
_START = re.compile(rb"\x1f\x8b\x08|WARC/1\.\d\r\n")
_PADDING = re.compile(rb"[\0\r\n]*")


def salvage(data: bytes) -> Iterator[dict]:
    """All whole records of an archive, and a row with ``problem`` for each gap.

    ``offset`` and ``length`` are those of the member, or of the plain record.  Within a
    member ``inner_offset`` and ``inner_length`` tell the place in its inflated bytes: a
    record there that fails a check is a gap of its own, and the search goes on at the
    next version line.  A member that cannot be inflated to its end, or whose checksum
    differs, is a gap itself; records before the damage are told with length 0, but for
    one that ends where the inflated bytes end, as nothing vouches for its end.
    """
    pos, bad, why = 0, None, None
    while pos < len(data):
        if bad is None:
            pos = _PADDING.match(data, pos).end()
            if pos == len(data):
                break
        rows, end, problem, after = [], None, None, pos + 1
        if data.startswith(b"\x1f\x8b", pos):
            raw, stop, problem = _inflated(data, pos)
            # Version lines before the damage belong to the member, and are done with it.
            end, after = None if problem else stop, max(stop, pos + 1) if problem else pos + 1
            for begin, stop, record, wrong in _plain(raw):
                place = {"offset": pos, "inner_offset": begin, "inner_length": stop - begin}
                if record is not None and (end is not None or stop < len(raw)):
                    rows.append(place | {"length": end - pos if end else 0, "problem": None, **record})
                elif record is None and end is not None:
                    rows.append(place | {"length": end - pos, "problem": wrong})
            if end is not None and rows and all(r["problem"] for r in rows):
                problem, end, rows = rows[0]["problem"], None, []
        else:
            try:
                record, end = _parse(data, pos)
                rows = [{"offset": pos, "length": end - pos, "problem": None, **record}]
            except ValueError as error:
                problem = str(error)
        if end is not None and bad is not None:
            yield {"offset": bad, "length": pos - bad, "problem": why}
            bad = None
        yield from rows
        if end is None:
            if bad is None:
                bad, why = pos, problem
            starts = [p.search(data, at) for p, at in ((_MEMBER, pos + 1), (_START, after))]
            pos = min((m.start() for m in starts if m), default=len(data))
        else:
            pos = end
    if bad is not None:
        yield {"offset": bad, "length": len(data) - bad, "problem": why}


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records (``problem`` is NULL) and quarantined gaps of all archives below ``path``.

    One archive is one row of Spark's file source, so memory follows the size of an
    archive, which the writer bounds.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                name, waiting, size = batch.column(0)[k].as_py(), [], 0
                for found in salvage(batch.column(1)[k].as_py()):
                    waiting.append({"path": name, **found})
                    size += len(found.get("payload") or b"") + 200
                    if size > 1 << 22:
                        yield pa.RecordBatch.from_pylist(waiting, _RECORDS)
                        waiting, size = [], 0
                if waiting:
                    yield pa.RecordBatch.from_pylist(waiting, _RECORDS)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(rows, RECORDS)


def page_number(record_id: Column) -> Column:
    """The number within a record id written here; NULL where there is none."""
    return F.regexp_extract(record_id, r"^<urn:x-page:(-?\d+)>$", 1).try_cast("bigint")

"""Exact substring deduplication by column-wise construction of suffix orders.

A byte goes when it is covered by a string of ``LENGTH`` bytes that also starts earlier:
in a document with a smaller id, or before in the same one.

*Dealing out.*  A window is a string of that length.  Its key is the least hash among
its grams of ``GRAM`` bytes, so equal windows have equal keys wherever they stand.
Neighbouring windows with one key form a segment.  Segments travel as hashes first: of
segments with the same content the earliest stays and the others go as a whole.  A window
that two others have in common holds the key's gram at the same place in both, and around
it one of the pieces of ``LENGTH - STEP`` bytes that begin every ``STEP`` bytes before the
gram.  Only segments with a piece that another one of their key has too, or whose key
has its gram in several places of a segment, can hold anything else; their bytes are fetched
and dealt into groups of bounded size.

*Within a group* the Burrows-Wheeler transform and common prefixes of all segments
are built by inserting one symbol of each per round (``suffixes.suffix_order``); symbols are
four bytes wide, and a segment takes part in each of its four alignments.
Neighbours in suffix order that share ``LENGTH`` bytes are equal windows; all but the
earliest go.  The sequential files of the published method are Spark's shuffle files: a
group is read from them in one go and is small enough to stay in memory.

*Hot keys.*  A key under which very many different segments may share a window (text
around a common passage) is cut into its single windows, segments of one window included, which are
dealt out by their own hash; equal ones then are equal segments, of which the earliest
stays.

Defined results: a NULL text is empty; texts of less than ``LENGTH`` bytes lose nothing.
Rows with the same id are in the order of a hash of their text, and equal rows count as
one document.  NULL ids come first.  Content is told apart by hashes of 96 bits or more in
the dealing, byte by byte within groups.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weektide.llm.grams import BASES, mix, rolling, salt, slices, utf8
from weektide.llm.store import stored, width_for
from weektide.llm.suffixes import suffix_order

#: Bytes of a string that may not occur twice.
LENGTH = 100
#: Bytes of the grams that keys are made of.
GRAM = 32
#: Windows of a segment at most.
WINDOWS = 128
#: Bytes from one piece around a key's gram to the next.
STEP = 17
#: How far before the gram the pieces begin: every window holds one of them.
PIECES = range(0, LENGTH - GRAM, STEP)
#: Different segments under one key that may share a window, from which on it is cut into windows.
HOT = 2048
#: Bytes of a group of segments, about.
GROUP = 1 << 19
#: Documents whose segments one task gets, about.
DOCS_A_TASK = 10_000
_SLICE = 1 << 21
_HELD = 600_000
_FAR = (1 << 28) - 1
_U = np.uint64


def segments(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
    """Begin, windows, key, content hash, "may repeat within" and hashes of the pieces (0
    for one that is not within) of every segment."""
    n = len(raw) - LENGTH + 1
    empty = np.zeros(0, np.int64)
    none = (
        empty, empty, empty.astype(_U), empty.astype(_U), empty.astype(bool),
        np.zeros((0, len(PIECES)), np.uint16),
    )
    if n <= 0:
        return none
    hashes = rolling(raw)
    grams = hashes(np.arange(len(raw) - GRAM + 1), GRAM)
    least = (grams & ~_U(_FAR)) | np.arange(len(grams)).astype(_U)
    span, reach = 1, LENGTH - GRAM + 1
    while span < reach:
        step = min(span, reach - span)
        least = np.minimum(least[: len(least) - step], least[step:])
        span += step
    place = (least & _U(_FAR)).astype(np.int64)
    # Windows lie within one text.
    ends = np.repeat(at[1:], np.diff(at))
    window = np.flatnonzero(np.arange(n) + LENGTH <= ends[:n])
    if not len(window):
        return none
    key = grams[place[window]]
    new = np.ones(len(window), bool)
    new[1:] = (np.diff(window) > 1) | (key[1:] != key[:-1])
    run = np.flatnonzero(new)
    new |= (np.arange(len(window)) - run[np.cumsum(new) - 1]) % WINDOWS == 0
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(window)) - 1
    begin, count = window[first], last - first + 1
    content = hashes(begin, count + LENGTH - 1)
    gram = place[begin]
    several = gram != place[window[last]]
    pieces = np.zeros((len(begin), len(PIECES)), np.uint16)
    for k, before in enumerate(PIECES):
        at_piece = gram - before
        fits = np.flatnonzero(
            (at_piece >= begin) & (at_piece + LENGTH - STEP < begin + count + LENGTH)
        )
        pieces[fits, k] = hashes(at_piece[fits], LENGTH - STEP) % _U(0xFFFF) + _U(1)
    return begin, count, mix(key[first]), content, several, pieces


class _Parcel:
    """Segments on their way, packed by bucket."""

    _KINDS = ("<u4", "<u2", "<u4", "<u2", "<u4", "<u4", "<u2", "u1", *["<u2"] * len(PIECES))

    def __init__(self, buckets: int):
        self._buckets, self._parts, self._docs, self.held = buckets, [], [], 0

    def add(self, docs: np.ndarray, owner, start, count, key, content, several, pieces) -> None:
        """Segments of the documents ``docs`` (pairs of id and text hash)."""
        base = sum(map(len, self._docs))
        self._docs.append(docs)
        self._parts.append((owner + base, start, count, key, content, several, pieces))
        self.held += len(owner)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        docs = np.concatenate(self._docs)
        owner, start, count, key, content, several, pieces = (
            np.concatenate([p[k] for p in self._parts]) for k in range(7)
        )
        order = np.lexsort((start, docs[owner, 1], docs[owner, 0], content, key))
        owner, start, count, key, content, several, pieces = (
            x[order] for x in (owner, start, count, key, content, several, pieces)
        )
        # Later copies within the parcel are settled; they only pass through.
        copy = np.zeros(len(key), bool)
        copy[1:] = (key[1:] == key[:-1]) & (content[1:] == content[:-1])
        head = np.maximum.accumulate(np.where(copy, 0, np.arange(len(key))))
        same = (docs[owner] == docs[owner[head]]).all(1) & (start == start[head])
        copy &= ~same
        flags = several.astype(np.uint8) | copy.astype(np.uint8) << 1
        bucket = np.where(copy, owner, (key & _U(0xFFFF)).astype(np.int64)) % self._buckets
        order = np.lexsort((start, owner, bucket))
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        for some in np.split(order, cuts[1:]):
            used, place = np.unique(owner[some], return_inverse=True)
            columns = (
                key[some] >> _U(32), (key[some] >> _U(16)) & _U(0xFFFF),
                content[some] >> _U(32), (content[some] >> _U(16)) & _U(0xFFFF),
                place, start[some], count[some], flags[some], *pieces[some].T,
            )
            blob = b"".join(
                [np.array([len(used), len(some)], "<u4").tobytes(), docs[used].tobytes()]
                + [c.astype(k).tobytes() for c, k in zip(columns, self._KINDS, strict=True)]
            )
            yield pa.record_batch(
                [pa.array([bucket[some[0]]], pa.int32()), pa.array([blob], pa.binary())],
                ["bucket", "blob"],
            )
        self._parts, self._docs, self.held = [], [], 0

    @classmethod
    def open(cls, blob: bytes) -> tuple[np.ndarray, ...]:
        """Documents by row, start, windows, key, content, flags and pieces."""
        n_docs, n = (int(x) for x in np.frombuffer(blob, "<u4", 2))
        docs = np.frombuffer(blob, np.int64, 2 * n_docs, 8).reshape(-1, 2)
        pos, found = 8 + 16 * n_docs, []
        for kind in cls._KINDS:
            found.append(np.frombuffer(blob, kind, n, pos))
            pos += n * np.dtype(kind).itemsize
        key = found[0].astype(_U) << _U(32) | found[1].astype(_U) << _U(16)
        content = found[2].astype(_U) << _U(32) | found[3].astype(_U) << _U(16)
        start, count = found[5].astype(np.int64), found[6].astype(np.int64)
        return docs[found[4]], start, count, key, content, found[7], np.stack(found[8:], 1)


_SETTLED = "doc bigint, tag bigint, start bigint, count bigint, key bigint, ask int"
#: What becomes of a segment: it goes; its bytes are asked for; those of its windows are.
_GOES, _ASKED, _HOT = 0, 1, 2


def _twins(place: np.ndarray, pieces: np.ndarray) -> np.ndarray:
    """Which segments have a piece that another one of their key, given by number, has too."""
    found = np.zeros(len(place), bool)
    for piece in pieces.T:
        rows = np.flatnonzero(piece)
        code = place[rows] << 16 | piece[rows]
        order = np.argsort(code)
        equal = np.diff(code[order]) == 0
        found[rows[order[1:][equal]]] = found[rows[order[:-1][equal]]] = True
    return found


def _settle(table: pa.Table) -> pa.Table:
    """Which segments go, and which are asked for, among all with the bucket's keys."""
    parts = [_Parcel.open(x.as_py()) for x in table.column("blob")]
    docs, start, count, key, content, flags, pieces = (
        np.concatenate([p[k] for p in parts]) for k in range(7)
    )
    passed = (flags & 2) > 0
    gone = [(docs[passed], start[passed], count[passed], key[passed])]
    docs, start, count, key, content, several, pieces = (
        x[~passed] for x in (docs, start, count, key, content, (flags & 1) > 0, pieces)
    )
    order = np.lexsort((start, docs[:, 1], docs[:, 0], content, key))
    docs, start, count, key, content, several, pieces = (
        x[order] for x in (docs, start, count, key, content, several, pieces)
    )
    copy = np.zeros(len(key), bool)
    copy[1:] = (key[1:] == key[:-1]) & (content[1:] == content[:-1])
    head = np.maximum.accumulate(np.where(copy, 0, np.arange(len(key))))
    same = (docs == docs[head]).all(1) & (start == start[head])
    gone.append(tuple(x[copy & ~same] for x in (docs, start, count, key)))
    docs, start, count, key, several, pieces = (
        x[~copy] for x in (docs, start, count, key, several, pieces)
    )
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    number = np.cumsum(new) - 1
    # The gram in several places of one segment: any of them may be that of another one.
    wanted = (np.bincount(number, several) > 0)[number]
    rest = np.flatnonzero(~wanted & (np.bincount(number)[number] > 1))
    wanted[rest] = _twins(number[rest], pieces[rest])
    ask = np.where(np.bincount(number, wanted)[number] > HOT, _HOT, _ASKED)
    found = gone + [tuple(x[wanted] for x in (docs, start, count, key))]
    asks = [np.zeros(len(g[1]), np.int32) for g in gone] + [ask[wanted].astype(np.int32)]
    docs, start, count, key = (np.concatenate([f[k] for f in found]) for k in range(4))
    return pa.table({
        "doc": docs[:, 0].copy(), "tag": docs[:, 1].copy(), "start": start, "count": count,
        "key": key.view(np.int64), "ask": np.concatenate(asks),
    })


def _symbols(
    text: np.ndarray, at: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The segments in symbols of several bytes: symbols, ends, where each begins, width.

    Each segment is read once for every way to cut its end off before the last symbol,
    so that all its bytes begin one symbol each.  Wide symbols make few rounds.  Four
    bytes are taken, or two or one if there are too many different ones; all divide
    ``LENGTH``, so a window is a whole number of symbols.
    """
    for width in (4, 2, 1):
        size = np.repeat(np.diff(at), width)
        left = np.tile(np.arange(width), len(at) - 1)
        count = np.maximum(size - left, 0) // width
        ends = np.cumsum(count)
        first = np.repeat(at[1:], width) - left - width * count
        spots = np.repeat(first, count) + width * (
            np.arange(int(count.sum())) - np.repeat(ends - count, count)
        )
        value = np.zeros(len(spots), np.uint32)
        for k in range(width):
            value = value << np.uint32(8) | text[spots + k]
        used, symbols = np.unique(value, return_inverse=True)
        if len(used) < 65_535:
            return symbols, ends, spots, width
    raise AssertionError("bytes have at most 256 values")


def _group(table: pa.Table) -> pa.Table:
    """Windows of a group of segments that also start earlier, as spans of bytes."""
    doc, tag, start = (table.column(c).to_numpy() for c in ("doc", "tag", "start"))
    text, at = utf8(pa.concat_arrays(table.column("bytes").chunks))
    symbols, ends, spots, width = _symbols(text, at)
    place, common = suffix_order(symbols, ends, LENGTH // width)
    place = spots[place]
    owner = np.searchsorted(at, place, "right") - 1
    whole = at[owner + 1] - place >= LENGTH
    group = np.cumsum(common < LENGTH // width)
    size = np.bincount(group[whole], minlength=group[-1] + 1 if len(group) else 0)
    rows = np.flatnonzero(whole)
    rows = rows[size[group[rows]] > 1]
    own, spot = owner[rows], start[owner[rows]] + place[rows] - at[owner[rows]]
    order = np.lexsort((spot, tag[own], doc[own], group[rows]))
    own, spot, member = own[order], spot[order], group[rows][order]
    later = np.zeros(len(own), bool)
    later[1:] = member[1:] == member[:-1]
    own, spot = own[later], spot[later]
    order = np.lexsort((spot, own))
    own, spot = own[order], spot[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (np.diff(spot) > 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(own)) - 1 if len(own) else first
    return pa.table({
        "doc": doc[own[first]], "tag": tag[own[first]], "start": spot[first],
        "count": spot[last] - spot[first] + 1,
    })


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, doc, tag, text``: ids with a place for NULL, and a hash of the text."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"))
    return rows.select(
        "doc_id", F.coalesce("doc_id", F.lit(-(1 << 63))).alias("doc"),
        F.xxhash64("text").alias("tag"), "text",
    )


def _deal(texts: DataFrame, buckets: int) -> DataFrame:
    """Parcels of all segments."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parcel = _Parcel(buckets)
        for batch in batches:
            for part in slices(batch, 2, _SLICE):
                raw, at = utf8(part.column(2))
                docs = np.stack([part.column(0).to_numpy(), part.column(1).to_numpy()], 1)
                begin, count, *marks = segments(raw, at)
                owner = np.searchsorted(at, begin, "right") - 1
                parcel.add(docs, owner, begin - at[owner], count, *marks)
                if parcel.held > _HELD:
                    yield from parcel.flush()
        yield from parcel.flush()

    return texts.select("doc", "tag", "text").mapInArrow(send, "bucket int, blob binary")


def _fetch(texts: DataFrame, asked: DataFrame, groups: int, buckets: int) -> DataFrame:
    """Bytes of the segments asked for with their group, and parcels of hot ones' windows."""
    schema = "bucket int, blob binary, doc bigint, tag bigint, start bigint, bytes binary"
    names = ["bucket", "blob", "doc", "tag", "start", "bytes"]
    kinds = [pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parcel = _Parcel(buckets)
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):
                doc, tag = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                raw = batch.column(2)[k].as_buffer().to_pybytes()
                for ask in batch.column(3)[k].as_py():
                    begin, count = ask["start"], ask["count"]
                    if ask["ask"] == _HOT:
                        piece = np.frombuffer(raw, np.uint8)[begin : begin + count + LENGTH - 1]
                        own, other = (
                            rolling(piece, base)(np.arange(count), LENGTH) for base in BASES
                        )
                        parcel.add(
                            np.array([[doc, tag]]), np.zeros(count, np.int64),
                            begin + np.arange(count), np.ones(count, np.int64),
                            mix(own + salt(1)), other, np.zeros(count, bool),
                            np.zeros((count, len(PIECES)), np.uint16),
                        )
                    else:
                        group = mix(np.array([ask["key"]], np.int64).view(_U))[0] >> _U(1)
                        piece = raw[begin : begin + count + LENGTH - 1]
                        rows.append((int(group) % groups, None, doc, tag, begin, piece))
            if rows:
                columns = zip(zip(*rows, strict=True), kinds, strict=True)
                yield pa.record_batch([pa.array(c, t) for c, t in columns], names)
            if parcel.held > _HELD:
                yield from _widen(parcel.flush())
        yield from _widen(parcel.flush())

    def _widen(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            blank = [pa.nulls(batch.num_rows, t) for t in kinds[2:]]
            yield pa.record_batch([*batch.columns, *blank], names)

    lists = asked.groupBy("doc", "tag").agg(
        F.collect_list(F.struct("start", "count", "key", "ask")).alias("asks")
    )
    distinct = texts.select("doc", "tag", "text").join(lists, ["doc", "tag"])
    once = distinct.select("doc", "tag", "text", "asks")
    return once.mapInArrow(cut, schema)


def _kept(raw: bytes, spans: list[dict] | None) -> tuple[int, int, int, str]:
    """Bytes, bytes removed, removed runs and SHA-256 of what is left."""
    left, at, runs = hashlib.sha256(), 0, 0
    removed, end = 0, -1
    for span in sorted(spans or [], key=lambda s: s["start"]):
        begin, stop = span["start"], span["start"] + span["count"] + LENGTH - 1
        if begin > end:
            runs += 1
            left.update(raw[max(at, 0) : begin])
            removed, end = removed + stop - begin, stop
        elif stop > end:
            removed, end = removed + stop - end, stop
        at = max(at, stop)
    left.update(raw[at:])
    return len(raw), removed, runs, left.hexdigest()


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What of every document is left; see the module's text."""
    spark = docs.sparkSession
    texts = _texts(docs, id_col, text_col)
    width = width_for(spark, texts.count(), DOCS_A_TASK)
    buckets = 2 * width

    def settled(parcels: DataFrame, name: str) -> DataFrame:
        dealt = parcels.repartition(width, "bucket").groupBy("bucket")
        return stored(dealt.applyInArrow(_settle, _SETTLED), name)

    first = settled(_deal(texts, buckets), "settled")
    asked = first.where(F.col("ask") != _GOES)
    size = asked.agg(F.sum(F.col("count") + LENGTH).alias("n")).first().n or 0
    groups = -(-size // GROUP) or 1
    fetched = stored(_fetch(texts, asked, groups, buckets), "fetched")
    windows = settled(fetched.where("blob is not null").select("bucket", "blob"), "windows")
    found = (
        fetched.where("blob is null").repartition(max(width, groups), "bucket")
        .groupBy("bucket").applyInArrow(_group, "doc bigint, tag bigint, start bigint, count bigint")
    )
    columns = ["doc", "tag", "start", "count"]
    goes = F.col("ask") == _GOES
    spans = (
        first.where(goes).select(*columns).unionByName(windows.where(goes).select(*columns))
        .unionByName(found).groupBy("doc", "tag")
        .agg(F.collect_list(F.struct("start", "count")).alias("spans"))
    )

    def left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (batch.column(0)[k].as_py(), *_kept(
                    batch.column(1)[k].as_buffer().to_pybytes(), batch.column(2)[k].as_py()
                ))
                for k in range(batch.num_rows)
            ]
            if rows:
                kinds = [pa.int64()] * 4 + [pa.string()]
                yield pa.record_batch(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
                    [c.split()[0] for c in RESULT.split(", ")],
                )

    joined = texts.join(spans, ["doc", "tag"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(left, RESULT)

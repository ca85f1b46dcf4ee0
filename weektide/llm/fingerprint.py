"""Similarity digests of improbable features.

A feature is a window of 64 bytes.  Its entropy, in 1/1000 of the largest, has a rank:
the rarer an entropy is among all windows of a corpus, the lower.  In every run of 64
neighbouring windows the one of the lowest rank (the leftmost of equals) scores; a
window that scores in enough of them is selected.  Selected features go into a chain of
Bloom filters, a new one after ``FULL`` features.  Two digests are compared by bit
overlap: each filter of the shorter chain with its best match in the other, above what
two random filters of these sizes share.

Windows of one byte repeated have no information and are never selected.  A text that
selects nothing has its whole bytes as the one feature (an empty text has none).

Defined results: NULL texts count as empty.  Two texts without features are alike (1),
one without and one with are not (0).  Equal texts have equal digests.  "Next" follows
falling ids, NULL ids last, rows of one id by their text; after the last row comes the
first, and a single row is its own next.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weektide.llm.grams import mix, salt, slices, utf8
from weektide.llm.store import shuffle_width

#: Bytes of a feature, and neighbouring windows that compete.
SIZE = 64
#: Runs that a window must win to be selected.
POPULAR = 16
#: Bits of a filter, bits set for a feature, features of a full filter.
BITS, HASHES, FULL = 2048, 5, 160
#: Levels of entropy.
LEVELS = 1000
_SLICE = 1 << 20
_U = np.uint64

_COUNT = np.arange(SIZE + 1)
#: What one more occurrence of a byte adds to the sum of c * log2(c), in exact units.
_TERM = np.rint(_COUNT * np.log2(np.maximum(_COUNT, 1)) * (1 << 20)).astype(np.int64)
_GAIN = np.diff(_TERM)


def entropies(raw: np.ndarray) -> np.ndarray:
    """Entropy level, 0 to LEVELS, of each window of ``SIZE`` bytes.

    The sum of c * log2(c) over the counts of a window changes by one term when a byte
    enters and by one when a byte leaves.  How often a byte occurs in the ``SIZE - 1``
    bytes before or after it shows in the order of (byte, place): two entries that are
    k apart there are close enough or not, and if not, no entries further apart are.
    """
    n = len(raw) - SIZE + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    order = np.argsort(raw, kind="stable")
    line = raw[order].astype(np.int64) * (len(raw) + SIZE) + order
    back, ahead = np.zeros(len(raw), np.uint8), np.zeros(len(raw), np.uint8)
    close = None
    for k in range(1, SIZE):
        if k < 4:
            near = line[k:] - line[:-k] < SIZE
            back[k:] += near
            ahead[:-k] += near
        else:
            close = np.flatnonzero(near) + 3 if close is None else close
            close = close[close >= k]
            close = close[line[close] - line[close - k] < SIZE]
            if not len(close):
                break
            back[close] += 1
            ahead[close - k] += 1
    before, after = np.empty(len(raw), np.uint8), np.empty(len(raw), np.uint8)
    before[order], after[order] = back, ahead
    first = _TERM[np.bincount(raw[:SIZE], minlength=256)].sum()
    change = np.empty(n, np.int64)
    change[0] = first
    change[1:] = _GAIN[before[SIZE:]] - _GAIN[after[: n - 1]]
    total = np.cumsum(change)
    full = SIZE * 6 * (1 << 20)
    return ((full - total) * LEVELS) // full


def ranks(counts: np.ndarray) -> np.ndarray:
    """Rank of every entropy level by how rare it is; level 0 comes last."""
    level = np.arange(LEVELS + 1)
    order = np.lexsort((level, counts))
    out = np.empty(LEVELS + 1, np.int64)
    out[order] = level
    out[0] = LEVELS + 1
    return out


def learn_counts(docs: DataFrame, text_col: str) -> np.ndarray:
    """How often each entropy level occurs among all windows of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(LEVELS + 1, np.int64)
        for batch in batches:
            for part in slices(batch, 0, _SLICE):
                raw, at = utf8(part.column(0))
                level = entropies(raw)
                # Windows that reach into the next text are none.
                owner = np.searchsorted(at, np.arange(len(level)), "right") - 1
                whole = np.arange(len(level)) + SIZE <= at[owner + 1]
                seen += np.bincount(level[whole], minlength=LEVELS + 1)
        level = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(level), pa.array(seen[level])], ["level", "n"])

    rows = docs.select(F.col(text_col).cast("string").alias("text")).where("text is not null")
    found = rows.mapInArrow(count, "level bigint, n bigint").groupBy("level").agg(F.sum("n").alias("n"))
    out = np.zeros(LEVELS + 1, np.int64)
    for row in found.collect():
        out[row.level] = row.n
    return out


def select(levels: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Begins of the selected windows."""
    if not len(levels):
        return np.zeros(0, np.int64)
    scored = rank[levels] << 40 | np.arange(len(levels))
    run, span = scored, 1
    reach = min(SIZE, len(levels))
    while span < reach:
        step = min(span, reach - span)
        run = np.minimum(run[: len(run) - step], run[step:])
        span += step
    best = run & ((1 << 40) - 1)
    wins = np.bincount(best, minlength=len(levels))
    need = POPULAR if len(levels) >= SIZE else 1
    chosen = np.flatnonzero(wins >= need)
    return chosen[levels[chosen] > 0]


def _hashes(raw: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each selected window."""
    windows = np.lib.stride_tricks.sliding_window_view(raw, SIZE)[begin]
    eights = mix(np.ascontiguousarray(windows).view("<u8") + _PLACES)
    return mix(eights.sum(1, dtype=_U))


_PLACES = np.array([salt(k) for k in range(1, SIZE // 8 + 1)], _U)


def digest(raw: np.ndarray, levels: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Filters, a row of 64-bit numbers each, and how many features each has."""
    begin = select(levels, rank)
    if len(begin):
        features = _hashes(raw, begin)
    elif len(raw):
        whole = hashlib.blake2b(raw.tobytes(), digest_size=8).digest()
        features = np.frombuffer(whole, _U)
    else:
        features = np.zeros(0, _U)
    number = np.arange(len(features)) // FULL
    filters = np.zeros((-(-len(features) // FULL), BITS // 64), _U)
    for k in range(HASHES):
        bit = (features >> _U(11 * k) & _U(BITS - 1)).astype(np.int64)
        np.bitwise_or.at(filters, (number, bit >> 6), _U(1) << (bit & 63).astype(_U))
    return filters, np.bincount(number, minlength=len(filters))


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """0 (nothing in common beyond chance) to 1."""
    if len(a[0]) > len(b[0]) or (len(a[0]) == len(b[0]) and a[0].tobytes() > b[0].tobytes()):
        a, b = b, a
    if not len(a[0]):
        return float(not len(b[0]))
    size_a = np.bitwise_count(a[0]).sum(1, dtype=np.int64)
    size_b = np.bitwise_count(b[0]).sum(1, dtype=np.int64)
    score = np.zeros(len(a[0]))
    for k, row in enumerate(a[0]):
        common = np.bitwise_count(b[0] & row).sum(1, dtype=np.int64)
        most = np.minimum(size_a[k], size_b)
        chance = size_a[k] * size_b / BITS
        score[k] = np.clip((common - chance) / np.maximum(most - chance, 1e-9), 0, 1).max()
    return float(np.average(score, weights=a[1]))


def as_text(found: tuple[np.ndarray, np.ndarray]) -> str:
    """A digest as text: feature counts and filters in hexadecimal."""
    return ":".join(f"{n:02x}{f.tobytes().hex()}" for f, n in zip(*found, strict=True))


def edit(text: str, following: str) -> str:
    """``text`` with its last half replaced by the first as many characters of the next."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _joined_levels(
    a: np.ndarray, levels_a: np.ndarray, b: np.ndarray, levels_b: np.ndarray
) -> np.ndarray:
    """Entropy levels of ``a + b``, given those of texts that begin with ``a`` and ``b``:
    only windows over the seam are new."""
    seam = entropies(np.concatenate([a[-(SIZE - 1) :], b[: SIZE - 1]]))
    return np.concatenate([
        levels_a[: max(0, len(a) - SIZE + 1)], seam, levels_b[: max(0, len(b) - SIZE + 1)]
    ])


class _Row:
    """A document with what its neighbours need of it."""

    def __init__(self, doc, text: str, raw: np.ndarray, levels: np.ndarray, rank: np.ndarray):
        self.doc, self.text, self.raw, self.levels = doc, text, raw, levels
        self.digest = digest(raw, levels, rank)

    def compare(self, following: _Row, rank: np.ndarray) -> tuple:
        half = len(self.text) // 2
        lead = len(self.text[: len(self.text) - half].encode())
        tail = len(following.text[:half].encode())
        raw = np.concatenate([self.raw[:lead], following.raw[:tail]])
        levels = _joined_levels(raw[:lead], self.levels, raw[lead:], following.levels)
        edited = digest(raw, levels, rank)
        return (
            self.doc, len(self.text), hashlib.sha256(raw.tobytes()).hexdigest(),
            as_text(self.digest), as_text(edited),
            likeness(self.digest, edited), likeness(self.digest, following.digest),
        )


RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
    ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()),
])


def _in_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows ``part, place, doc, text`` such that within a part, by ``place``, each row is
    followed by its next one; the last row of a part (``place`` = 1) is only a next.

    Parts are ranges of ids, cut at quantiles.  Each part gets a copy of the row that
    comes after its last: one more row per part, however large the table is.
    """
    lowest = -(1 << 63)
    rows = docs.select(
        F.coalesce(F.col(id_col).cast("bigint"), F.lit(lowest)).alias("at"),
        F.col(id_col).cast("bigint").alias("doc"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    wanted = shuffle_width(docs.sparkSession)
    shares = [k / wanted for k in range(1, wanted)]
    cuts = rows.select("at").approxQuantile("at", shares, 0.25 / wanted) if shares else []
    cuts = np.unique(np.array(cuts, np.int64))

    @F.pandas_udf("int")
    def part_of(at: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, at, "right").astype(np.int32))

    rows = rows.withColumn("part", part_of("at"))
    # Falling ids: a part's last row is followed by the first row of the next lower part
    # that has rows, and the last row of all by the first of all.
    tops = {r.part: r.top for r in rows.groupBy("part").agg(F.max("at").alias("top")).collect()}
    there = sorted(tops)
    highest = np.full(len(cuts) + 1, lowest)
    target = np.zeros(len(cuts) + 1, np.int32)
    for k, p in enumerate(there):
        highest[p], target[p] = tops[p], there[(k + 1) % len(there)]

    @F.pandas_udf("boolean")
    def is_top(part: pd.Series, at: pd.Series) -> pd.Series:
        return pd.Series(highest[part] == at.to_numpy())

    @F.pandas_udf("int")
    def sent_to(part: pd.Series) -> pd.Series:
        return pd.Series(target[part])

    heads = (
        rows.where(is_top("part", "at"))
        .groupBy("part").agg(F.min(F.struct("at", "text", "doc")).alias("head"))
    )
    copies = heads.select(
        sent_to("part").alias("part"), F.lit(1).alias("place"), "head.at", "head.doc", "head.text"
    )
    return rows.select("part", F.lit(0).alias("place"), "at", "doc", "text").unionByName(copies)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Digests of every document and of its edited text, and their likeness."""
    rank = ranks(learn_counts(docs, text_col))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, part = None, None
        for batch in batches:
            for piece in slices(batch, 4, _SLICE):
                raw, at = utf8(piece.column(4))
                levels, out = entropies(raw), []
                for k in range(piece.num_rows):
                    here, doc, text = (piece.column(c)[k].as_py() for c in (0, 3, 4))
                    own = levels[at[k] : max(at[k], at[k + 1] - SIZE + 1)]
                    row = _Row(doc, text, raw[at[k] : at[k + 1]], own, rank)
                    if waiting is not None and here == part:
                        out.append(waiting.compare(row, rank))
                    waiting, part = row, here
                if out:
                    yield _batch(out)

    rows = _in_order(docs, id_col, text_col)
    width = shuffle_width(docs.sparkSession)
    ordered = rows.repartition(width, "part").sortWithinPartitions(
        "part", "place", F.col("at").desc(), "text"
    )
    return ordered.mapInArrow(walk, RESULT)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _RESULT, strict=True)],
        schema=_RESULT,
    )

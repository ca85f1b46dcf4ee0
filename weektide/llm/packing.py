"""Packing documents into token sequences by minimum bin slack.

Every document is cut into full pieces of ``capacity`` ids and one remainder.  Full
pieces are sequences of their own.  Remainders are packed by their lengths: a dynamic
program over subset sums, held as bits of one integer, finds the multiset of lengths
that fills a window closest to the capacity; going back through its states gives how
often each length is used.  The same multiset is taken as often as the remaining
counts allow, so the plan is made from the counts per length alone: at most
``capacity - 1`` numbers, whatever the size of the corpus.  A window that no multiset
fills gets a cut piece of a waiting remainder; the last window is cut into powers of
two, which need no padding.

Which document takes which place follows from its rank among remainders of its
length.  Ranks come from counts per (chunk of ids, length), so no window runs over all
documents of one length.

Defined results: a NULL text is an empty one and gives the closing id alone; equal
rows are packed once each; an empty table gives no pieces; NULL ids are packed too.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weektide.llm.grams import SPACES, slices, utf8, word_hashes
from weektide.llm.store import shuffle_width, stored

#: Length of a sequence.
CAPACITY = 2048
#: Id that closes a document.
END_ID = 1
#: Distinct words whose ids a task remembers; it starts afresh beyond.
REMEMBERED = 400_000
#: Cut remainders that are sent to every task; more of them are joined by a shuffle.
SENT = 20_000
#: Bytes tokenized at a time.
_SLICE = 1 << 21

_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123)]] = True

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def word_starts(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where words begin in the bytes of texts that begin at ``at``; words tile the texts.

    A pre-token never goes on from a sign to white space, nor from a letter to an ASCII
    sign or digit.  So a word is white space and what follows up to the next white space;
    but if that begins with letters, it ends after them.  Letters are those of Latin-1.
    """
    n = len(raw)
    white, letter = SPACES[raw], _LETTERS[raw]
    # Characters of more bytes: white space of Unicode, and the letters from C0 to FF.
    high = np.flatnonzero(raw >= 0xC2)
    if len(high):
        one = raw[np.minimum(high + 1, n - 1)]
        two = raw[np.minimum(high + 2, n - 1)]
        pair = (raw[high] == 0xC2) & ((one == 0x85) | (one == 0xA0))
        triple = (
            ((raw[high] == 0xE1) & (one == 0x9A) & (two == 0x80))
            | ((raw[high] == 0xE2) & (one == 0x80) & ((two <= 0x8A) | (two == 0xA8) | (two == 0xA9) | (two == 0xAF)))
            | ((raw[high] == 0xE2) & (one == 0x81) & (two == 0x9F))
            | ((raw[high] == 0xE3) & (one == 0x80) & (two == 0x80))
        )
        for k in range(3):
            white[high[triple] + k] = True
            if k < 2:
                white[high[pair] + k] = True
        latin = high[(raw[high] == 0xC3) & (one != 0x97) & (one != 0xB7)]
        letter[latin] = letter[latin + 1] = True
    first = np.zeros(n + 1, bool)
    first[at] = True
    begin = first.copy()
    begin[1:n] |= white[1:] & ~white[:-1]
    # Runs of letters that stand at the beginning of a word, and what follows them.
    edge = np.zeros(n + 1, bool)
    edge[1:n] = letter[1:] != letter[:-1]
    edge[0], edge[n] = n > 0 and letter[0], n > 0 and letter[-1]
    split = first[:-1] & letter
    split[:1] = False
    split[1:] &= letter[:-1]
    edges = np.sort(np.concatenate([np.flatnonzero(edge), np.repeat(np.flatnonzero(split), 2)]))
    starts, ends = edges[::2], edges[1::2]
    lead = first[starts] | white[np.maximum(starts - 1, 0)]
    ends = ends[lead & (ends < n)]
    begin[ends[(raw[ends] < 128) & ~white[ends]]] = True
    return np.flatnonzero(begin[:n])


def ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Indices of all entries of pieces, given where they begin and their sizes."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class WordIds:
    """Ids of texts.  Words are looked up by hash, and their bytes compared; the tokenizer
    sees each distinct word once while it is remembered."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        self._model, self._most = _tokenizer(path), remembered
        self._forget()

    def _forget(self) -> None:
        self._hashes = np.zeros(0, np.uint64)
        self._word = np.zeros(0, np.int64)
        self._sizes = np.zeros((2, 0), np.int64)  # bytes and ids of each word
        self._starts = np.zeros((2, 0), np.int64)
        self._bytes, self._ids = np.zeros(0, np.uint8), np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        got = [e.ids for e in self._model.encode_batch_fast([w.decode() for w in words], add_special_tokens=False)]
        sizes = np.array([[len(w) for w in words], [len(g) for g in got]], np.int64)
        starts = np.cumsum(sizes, axis=1) - sizes + np.array([[len(self._bytes)], [len(self._ids)]])
        word = np.concatenate([self._word, len(self._word) + np.arange(len(words))])
        hashes = np.concatenate([self._hashes, hashes])
        order = np.argsort(hashes, kind="stable")
        self._hashes, self._word = hashes[order], word[order]
        self._sizes = np.concatenate([self._sizes, sizes], axis=1)
        self._starts = np.concatenate([self._starts, starts], axis=1)
        self._bytes = np.concatenate([self._bytes, np.frombuffer(b"".join(words), np.uint8)])
        self._ids = np.concatenate([self._ids, np.fromiter(chain.from_iterable(got), np.uint32)])

    def slice(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, and where each text's begin; ``at`` as in ``grams.utf8``."""
        begin = word_starts(raw, at)
        sizes = np.diff(begin, append=len(raw))
        hashes, first, which = np.unique(
            word_hashes(raw, begin, begin + sizes), return_index=True, return_inverse=True
        )
        spot = np.minimum(np.searchsorted(self._hashes, hashes), max(len(self._hashes) - 1, 0))
        new = self._hashes[spot] != hashes if len(self._hashes) else np.ones(len(hashes), bool)
        if len(self._hashes) + new.sum() > self._most:
            self._forget()
            new[:] = True
        if new.any():
            chosen = first[new]
            self._learn(hashes[new], [raw[b : b + n].tobytes() for b, n in zip(begin[chosen], sizes[chosen], strict=True)])
        word = self._word[np.searchsorted(self._hashes, hashes)][which]
        known = self._bytes[ragged(self._starts[0, word], self._sizes[0, word])]
        if len(known) != len(raw) or (known != raw).any():  # two words with one hash
            texts = [raw[a:b].tobytes().decode() for a, b in zip(at[:-1], at[1:], strict=True)]
            got = [e.ids for e in self._model.encode_batch_fast(texts, add_special_tokens=False)]
            return np.fromiter(chain.from_iterable(got), np.uint32), np.cumsum([0, *map(len, got)])
        counts = np.concatenate([[0], np.cumsum(self._sizes[1, word])])
        return self._ids[ragged(self._starts[1, word], self._sizes[1, word])], counts[np.searchsorted(begin, at)]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as packed little-endian 32-bit numbers."""
        ids, at = self.slice(*utf8(pa.array(texts, pa.large_string())))
        packed = ids.astype("<u4")
        return [packed[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]


def cut(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, start and length of the pieces of documents with that many ids: full
    ones, then the remainder."""
    pieces = -(-sizes // capacity)
    whose = np.repeat(np.arange(len(sizes)), pieces)
    start = ragged(np.zeros(len(sizes), np.int64), pieces) * capacity
    return whose, start, np.minimum(sizes[whose] - start, capacity)


def tokenize(
    docs: DataFrame, id_col: str, text_col: str, path: str,
    capacity: int = CAPACITY, end_id: int = END_ID,
) -> DataFrame:
    """Pieces of every document: id, start, length, CRC-32 of the ids, tokens in all."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordIds(path)
        for batch in batches:
            for part in slices(batch, 1, _SLICE):
                ids, at = encode.slice(*utf8(part.column(1)))
                sizes = np.diff(at) + 1
                ends = np.cumsum(sizes)
                closed = np.full(ends[-1], end_id, "<u4")
                inner = np.ones(len(closed), bool)
                inner[ends - 1] = False
                closed[inner] = ids
                whose, start, length = cut(sizes, capacity)
                first, raw = (ends - sizes)[whose] + start, memoryview(closed).cast("B")
                crc = [zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(first.tolist(), length.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(whose)), pa.array(start), pa.array(length),
                     pa.array(crc, pa.int64()), pa.array(sizes[whose])],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
                )

    rows = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
    return rows.mapInArrow(pieces, PIECES)


def best_multiset(counts: dict[int, int], capacity: int) -> list[tuple[int, int]]:
    """Lengths and how often each is used, for the fullest window that ``counts`` allow.

    Bit ``s`` of a state says that the lengths seen so far can add up to ``s``.
    Counts are split into powers of two; the search starts from the longest length,
    which every window uses, and ends as soon as the window can be filled.
    """
    order = sorted((n for n, c in counts.items() if c), reverse=True)
    if not order:
        return []
    within, states = (1 << (capacity + 1)) - 1, []
    reach = 1 << order[0]
    for k, length in enumerate(order):
        left, times = min(counts[length], capacity // length) - (k == 0), 1
        while left > 0 and not reach >> capacity & 1:
            use = min(times, left)
            states.append((length, use, reach))
            reach |= reach << (length * use) & within
            left -= use
            times *= 2
        if reach >> capacity & 1:
            break
    total, used = reach.bit_length() - 1, {order[0]: 1}
    for length, use, before in reversed(states):
        if not before >> total & 1:
            used[length] = used.get(length, 0) + use
            total -= length * use
    return list(used.items())


def _powers(n: int) -> list[int]:
    """``n`` as falling powers of two."""
    return [1 << b for b in range(n.bit_length() - 1, -1, -1) if n >> b & 1]


_PLAN = "n bigint, rank bigint, times bigint, part_start bigint, part bigint, sequence bigint, at bigint"


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple], int]:
    """Places of all remainders, given how many there are of each length, and the
    number of sequences.

    A row ``(n, rank, times, part_start, part, sequence, at)`` says: the remainders of
    length ``n`` with ranks ``rank .. rank + times - 1`` put ``part`` ids from
    ``part_start`` on at offset ``at`` of the sequences from ``sequence`` on, one each.
    """
    held = {n: deque([(n, 0, c, 0)]) for n, c in counts.items() if c > 0}
    counts = {n: c for n, c in counts.items() if c > 0}
    rows: list[tuple] = []

    def take(length: int, times: int, size: int, sequence: int, at: int) -> None:
        """Use the first ``size`` ids of ``times`` remainders; the rest of them waits."""
        counts[length] -= times
        while times:
            n, rank, there, start = held[length].popleft()
            use = min(there, times)
            rows.append((n, rank, use, start, size, sequence, at))
            if there > use:
                held[length].appendleft((n, rank + use, there - use, start))
            if size < length:
                held.setdefault(length - size, deque()).append((n, rank, use, start + size))
                counts[length - size] = counts.get(length - size, 0) + use
            times, sequence = times - use, sequence + use
        if not counts[length]:
            del counts[length]

    sequence, total = 0, sum(n * c for n, c in counts.items())
    while total >= capacity:
        chosen = best_multiset(counts, capacity)
        slack, use = capacity - sum(n * c for n, c in chosen), dict(chosen)
        if slack:
            donor = max(n for n, c in counts.items() if c > use.get(n, 0))
            use[donor] = use.get(donor, 0) + 1
        times, at = min(counts[n] // c for n, c in use.items()), 0
        for n, c in chosen:
            for _ in range(c):
                take(n, times, n, sequence, at)
                at += n
        if slack:
            take(donor, times, slack, sequence, at)
        sequence, total = sequence + times, total - times * capacity
    for size in _powers(total):
        at = 0
        while at < size:
            n = max(counts)
            part = min(n, size - at)
            take(n, 1, part, sequence, at)
            at += part
        sequence += 1
    return rows, sequence


def pack(
    docs: DataFrame, id_col: str, text_col: str, path: str,
    capacity: int = CAPACITY, end_id: int = END_ID,
) -> DataFrame:
    """Pieces of all documents with their sequence and offset; see the module's text.

    ``path`` names the tokenizer's file.  One pass tokenizes and stores the pieces;
    only documents that the plan cuts are tokenized once more.
    """
    spark = docs.sparkSession
    pieces = stored(tokenize(docs, id_col, text_col, path, capacity, end_id), "pieces")
    lengths = pieces.groupBy("length").agg(F.count("*").alias("n")).collect()
    counts = {r.length: r.n for r in lengths}
    counts.pop(capacity, 0)
    places, sequences = plan(counts, capacity)
    plan_rows = spark.createDataFrame(places, _PLAN)

    # Rank among the pieces of one length: counts of earlier chunks, then within a chunk.
    chunks = 4 * shuffle_width(spark)
    chunk = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(chunks))
    pieces = pieces.withColumn("chunk", chunk)
    before = pieces.groupBy("length", "chunk").agg(F.count("*").alias("c")).select(
        "length", "chunk",
        (F.sum("c").over(Window.partitionBy("length").orderBy("chunk")) - F.col("c")).alias("before"),
    )
    within = Window.partitionBy("length", "chunk").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    ranked = (
        pieces.withColumn("k", F.row_number().over(within) - 1)
        .join(before, ["length", "chunk"])
        .withColumn("r", F.col("before") + F.col("k")).drop("chunk", "before", "k")
    )
    full = ranked.where(F.col("length") == capacity).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("r") + sequences).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"),
    )
    # The plan has at most some rows per length: a table of bounded size.
    placed = stored(
        ranked.where(F.col("length") < capacity)
        .join(F.broadcast(plan_rows), F.expr("length = n and r >= rank and r < rank + times"))
        .withColumn("sequence_id", F.col("sequence") + F.col("r") - F.col("rank")),
        "placed",
    )
    whole = placed.where("part = length").select(*full.columns[:6], F.col("at").alias("offset"))
    cuts = placed.where("part < length")
    # The plan says how many remainders it cuts; few of them are sent to the texts.
    if sum(row[2] for row in places if row[4] < row[0]) <= SENT:
        cuts = F.broadcast(cuts)
    return full.unionByName(whole).unionByName(_recount(docs, id_col, text_col, path, cuts, end_id))


def _recount(docs, id_col, text_col, path, cuts, end_id) -> DataFrame:
    """Cut parts with the CRC-32 of their own ids."""
    end = np.array([end_id], "<u4").tobytes()
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").alias("text")
    )
    found = texts.join(cuts, F.col("id").eqNullSafe(F.col("doc_id"))).select(
        "doc_id", "start", "ids_crc32", "doc_tokens", "part_start", "part", "sequence_id", "at",
        "text",
    )

    def crc(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = WordIds(path)
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                ids = encode([row.text or ""])[0] + end
                rest = ids[4 * row.start :]
                if len(ids) // 4 != row.doc_tokens or zlib.crc32(rest) != row.ids_crc32:
                    continue  # another row with the same id
                a, n = row.part_start, row.part
                out.append((row.doc_id, row.start + a, n, zlib.crc32(rest[4 * a : 4 * (a + n)]),
                            row.doc_tokens, row.sequence_id, row.at))
            yield pd.DataFrame(out, columns=_OUT.replace(" bigint", "").split(", ")).astype(
                {"doc_id": "Int64"}
            )

    return found.mapInPandas(crc, _OUT).distinct()


_OUT = PIECES + ", sequence_id bigint, offset bigint"

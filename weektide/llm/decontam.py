"""Benchmark decontamination: test items found inside documents of any length.

An item counts as contained in a document when the document has at least 4/5 of the
item's distinct word shingles.  Similarity of whole sets says nothing here, as a
document may be a thousand times as long as the item, and independent minima would
miss items at that ratio.  So each item's sketch is the minima of its hashed set, as
many as its size demands: of ``q`` shingles, any 4/5 include one of the
``q - ceil(4q/5) + 1`` smallest.  Items are partitioned by size; a partition's sketches
are looked up among the documents that have shingles enough for its smallest item.
Hits are counted on the hashed sets, then verified on the words themselves.  The search
loses nothing that the definition asks for.

Items are sent to the tasks in blocks of bounded size, one pass over the documents for
each, so a larger benchmark makes more passes, not larger tasks.

Defined results: an item of fewer than five words is sought as that one run of words;
an item without words (or with a NULL text) is in no document; a document without words
contains nothing; equal rows give one pair; empty tables give no pairs.  NULL ids are
carried along.  A-Z count as a-z, words end at ASCII white space.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weektide.llm.grams import mix, shingle_sets, slices

#: Words of a shingle.
WIDTH = 5
#: Shingles of all items in one block, about: 8 bytes each in every task.
BLOCK = 1 << 20
_SLICE = 1 << 21
_TABLE = 1 << 22
_U = np.uint64
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

PAIRS = "doc_id bigint, item_id bigint, n_item bigint, n_common bigint, containment double"


def least_common(size):
    """Shingles that must be in common with an item of ``size`` shingles."""
    return -(-4 * size // 5)


def words_of(text: str | None) -> list[bytes]:
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(_LOWER))


def shingles_of(words: list[bytes], width: int) -> set[tuple[bytes, ...]]:
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}


@dataclass(frozen=True)
class Partition:
    """Items of one shingle width whose sizes lie within a factor of two."""

    width: int
    least: int
    ids: list
    texts: list[str]
    sets: list[np.ndarray]
    minima: np.ndarray
    owner: np.ndarray


def partitions(items: list[tuple]) -> list[Partition]:
    """Items ``(id, text)`` by width and size, with the sorted sketches of all."""
    groups: dict[tuple[int, int], list] = {}
    for item, text in items:
        width = min(WIDTH, len(words_of(text)))
        if width:
            found, _ = shingle_sets(pa.array([text], pa.string()), width)
            groups.setdefault((width, len(found).bit_length()), []).append((item, text, found))
    out = []
    for (width, _), rows in sorted(groups.items()):
        sketch = [f[: len(f) - least_common(len(f)) + 1] for _, _, f in rows]
        minima = np.concatenate(sketch)
        owner = np.repeat(np.arange(len(rows)), [len(s) for s in sketch])
        order = np.argsort(minima, kind="stable")
        out.append(Partition(
            width, min(least_common(len(f)) for _, _, f in rows), [r[0] for r in rows],
            [r[1] for r in rows], [r[2] for r in rows], minima[order], owner[order],
        ))
    return out


def _candidates(
    part: Partition, seen: np.ndarray, found: np.ndarray, at: np.ndarray
) -> Iterator[tuple[int, int]]:
    """Document and item whenever one of the item's minima is in the document."""
    place = np.flatnonzero(seen[(mix(found) & _U(_TABLE - 1)).astype(np.int64)])
    low = np.searchsorted(part.minima, found[place], "left")
    high = np.searchsorted(part.minima, found[place], "right")
    hit = high > low
    docs = np.searchsorted(at, place[hit], "right") - 1
    big = np.diff(at)[docs] >= part.least
    pairs = {
        (int(d), int(i))
        for d, a, b in zip(docs[big], low[hit][big], high[hit][big], strict=True)
        for i in part.owner[a:b]
    }
    yield from sorted(pairs)


def _search(parts: list[Partition], ids: pa.Array, texts: pa.Array) -> list[tuple]:
    rows, sets = [], {}
    for part in parts:
        if part.width not in sets:
            sets[part.width] = shingle_sets(texts, part.width)
        found, at = sets[part.width]
        seen = np.zeros(_TABLE, bool)
        seen[(mix(part.minima) & _U(_TABLE - 1)).astype(np.int64)] = True
        for doc, item in _candidates(part, seen, found, at):
            want, have = part.sets[item], found[at[doc] : at[doc + 1]]
            spot = np.minimum(np.searchsorted(have, want), len(have) - 1)
            if (have[spot] == want).sum() < least_common(len(want)):
                continue
            exact = shingles_of(words_of(part.texts[item]), part.width)
            common = len(exact & shingles_of(words_of(texts[doc].as_py()), part.width))
            if common >= least_common(len(exact)):
                n = len(exact)
                rows.append((ids[doc].as_py(), part.ids[item], n, common, common / n))
    return rows


def find_items(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", block: int = BLOCK,
) -> DataFrame:
    """``doc_id, item_id, n_item, n_common, containment`` of every contained item."""
    rows = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
    asked = items.select(
        F.col(item_col).cast("bigint").alias("id"), F.col(item_text_col).cast("string").alias("text")
    ).where("text is not null").distinct()
    total = asked.agg(F.sum(F.length("text")).alias("n")).first().n or 0
    blocks = -(-total // (4 * block)) or 1  # a word has about four letters at least
    number = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    found = []
    for k in range(blocks):
        parts = partitions([tuple(r) for r in asked.where(number == k).collect()])

        def search(batches: Iterator[pa.RecordBatch], parts=parts) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for piece in slices(batch, 1, _SLICE):
                    out = _search(parts, piece.column(0), piece.column(1))
                    if out:
                        columns = list(zip(*out, strict=True))
                        yield pa.record_batch(
                            [pa.array(c, pa.int64()) for c in columns[:4]] + [pa.array(columns[4])],
                            ["doc_id", "item_id", "n_item", "n_common", "containment"],
                        )

        found.append(rows.mapInArrow(search, PAIRS))
    return reduce(DataFrame.unionByName, found).distinct()

"""Similarity join of word-shingle sets by partition and enumeration (PartEnum).

Two sets of at least 4/5 similarity differ in at most a ninth of their added sizes.
Sets are compared within bands of about equal size, so each band has a largest
difference k.  The hashed shingle domain is split into parts, each part into cells; as
only k shingles differ, some part has at most ``SPARE`` of them, and so agrees in all
but ``SPARE`` of its cells.  A signature is the content of one such subset of cells;
similar sets share at least one.

*Empty subsets* agree by chance and are not used.  A set has enough parts without them
almost always; where it hasn't, it also gives its first shingles in hash order, as many
as must overlap between similar sets.

*Work within a group that shares a signature.*  Equal sets count as one.  A group goes to
one task; of a large group, all members are first tried with the smallest one, row by
row, and what that refuses is cut into blocks, of which any two meet.  The middle
member is tried against the rest, those it can't be similar to among themselves, and
so on: one try per member.  The test is a parity bitmap of a set, whose differing bits
never exceed the differing shingles, so nothing similar is refused.  Tries are
verified on the sets themselves, and linked members merge.  A set has tries from many
groups, so only the one with the closest partner is verified at first, then those
whose two sets are not connected by that.  Last, members of one group that may be
similar but are still not connected are tried one by one.  Links inside what is already
connected are not needed for components.

Defined results: texts that are NULL or without words have no set, are linked with
nothing and are components of their own; equal rows are linked; an empty table gives
no rows.  A NULL id is carried along; a component is named by its smallest id.
Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weektide.llm.components import components
from weektide.llm.grams import mix, salt, shingle_sets, slices
from weektide.llm.store import sent_if_few, stored, width_for

#: Words of a shingle.
WIDTH = 5
#: Cells of a part, and how many of them may differ.
CELLS, SPARE = 2, 1
#: A band's largest size over that of the band before.
BAND = 1.6
#: Buckets of signatures at least; every bucket repeats the keys of most documents.
LEAST_BUCKETS = 64
#: Documents whose signatures one task gets, about (2 KB each).
DOCS_A_TASK = 10_000
#: Members of a group that one task takes; larger groups are cut.
MOST = 20_000
#: Signatures and documents a task holds before it hands them on.
_HELD, _DOCS = 1_500_000, 60_000
_SLICE = 1 << 21
_U = np.uint64
_SUBSETS = list(combinations(range(CELLS), CELLS - SPARE))


def similar(a: int, b: int, common: int) -> bool:
    """At least 4/5 of the union in common, in whole numbers."""
    return 100 * common >= 80 * (a + b - common)


def bands(largest: int) -> list[tuple[int, int]]:
    """Smallest and largest size of each band, up to one that holds ``largest``.

    A band starts at 4/5 of the sizes that are new in it, so a similar pair lies
    together in the band that its larger set is new in.
    """
    out, top = [], 0
    while top < largest:
        new = top + 1
        top = max(new, int(BAND * top))
        out.append((-(-4 * new // 5), top))
    return out


def set_keys(found: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A 64-bit key of every set; 0 for the empty one."""
    sums = np.zeros(len(found) + 1, _U)
    np.cumsum(mix(found ^ _U(0x5DEECE66D)), out=sums[1:])
    keys = mix(sums[at[1:]] - sums[at[:-1]] + np.diff(at).astype(_U))
    keys[np.diff(at) == 0] = 0
    return keys


def parity_maps(found: np.ndarray, at: np.ndarray) -> list[bytes]:
    """For every set, which of its bit positions an odd number of shingles falls on.

    A map has at least as many bits as the set has members, in a power of two, so a
    longer map folds to a shorter one by halves.
    """
    size = np.diff(at)
    bits = np.int64(1) << np.maximum(6, np.ceil(np.log2(np.maximum(size, 1)))).astype(np.int64)
    begin = np.concatenate([[0], np.cumsum(bits)])
    owner = np.repeat(np.arange(len(size)), size)
    place = begin[owner] + (found & (bits[owner] - 1).astype(_U)).astype(np.int64)
    odd = (np.bincount(place, minlength=begin[-1]) & 1).astype(bool)
    packed = np.packbits(odd, bitorder="little").tobytes()
    return [packed[b // 8 : e // 8] for b, e in zip(begin[:-1], begin[1:], strict=True)]


def signatures(
    found: np.ndarray, at: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Signatures and the set each is of, band by band."""
    size = np.diff(at)
    for band, (low, top) in enumerate(bands(int(size.max(initial=0)))):
        inside = np.flatnonzero((size >= low) & (size <= top))
        if not len(inside):
            continue
        x = size[inside]
        differ = 2 * top // 9
        parts = int(1.05 * (differ // (SPARE + 1) + 1)) + 1
        owner = np.repeat(np.arange(len(inside)), x)
        member = np.arange(len(owner)) + np.repeat(at[inside] - (np.cumsum(x) - x), x)
        h = found[member]
        spread = mix(h + salt(band + 1))
        cell = (owner * parts + (spread % _U(parts)).astype(np.int64)) * CELLS
        cell += ((spread >> _U(40)) % _U(CELLS)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        first = np.flatnonzero(np.diff(cell, prepend=-1))
        content = np.zeros(len(inside) * parts * CELLS, _U)
        content[cell[first]] = np.add.reduceat(mix(h[order]), first)
        there = np.zeros(len(content), bool)
        there[cell[first]] = True
        content, there = content.reshape(-1, CELLS), there.reshape(-1, CELLS)
        whole = np.ones(len(content), bool)
        for k, subset in enumerate(_SUBSETS):
            some = there[:, subset].any(1)
            whole &= some
            rows = np.flatnonzero(some)
            tag = ((rows % parts) * len(_SUBSETS) + k).astype(_U) << _U(8) | _U(band)
            yield mix(content[rows][:, subset].sum(1, dtype=_U) + mix(tag)), inside[rows // parts]
        # Parts with more than SPARE differences, at most, between a set and a similar one.
        worst = (x + np.minimum(5 * x // 4, top)) // 9 // (SPARE + 1)
        weak = np.flatnonzero(whole.reshape(-1, parts).sum(1) <= worst)
        for i in weak:
            n, begin = int(x[i]), at[inside[i]]
            lead = found[begin : begin + n - (-(-4 * n // 5)) + 1]
            yield mix(lead + _U(0xC0FFEE + band)), np.full(len(lead), inside[i])


def describe(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n_shingles, key, parity`` of every document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, _SLICE):
                found, at = shingle_sets(part.column(1), WIDTH)
                yield pa.record_batch(
                    [part.column(0), pa.array(np.diff(at)),
                     pa.array(set_keys(found, at).view(np.int64)),
                     pa.array(parity_maps(found, at), pa.binary())],
                    ["doc_id", "n_shingles", "key", "parity"],
                )

    return _texts(docs, id_col, text_col).mapInArrow(
        rows, "doc_id bigint, n_shingles bigint, key bigint, parity binary"
    )


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")
    )


def _pack(keys: np.ndarray, sigs: np.ndarray, local: np.ndarray) -> bytes:
    """Keys once each, then 48 bits and the place of its key for every signature."""
    used, place = np.unique(local, return_inverse=True)
    head = np.array([len(used), len(sigs)], np.uint32)
    return b"".join(x.tobytes() for x in (
        head, keys[used], (sigs >> _U(32)).astype(np.uint32),
        (sigs >> _U(16)).astype(np.uint16), place.astype(np.uint16),
    ))


def _unpack(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n_keys, n = np.frombuffer(blob, np.uint32, 2)
    keys = np.frombuffer(blob, _U, n_keys, 8)
    pos = 8 + 8 * int(n_keys)
    high = np.frombuffer(blob, np.uint32, n, pos).astype(_U) << _U(16)
    low = np.frombuffer(blob, np.uint16, n, pos + 4 * int(n)).astype(_U)
    place = np.frombuffer(blob, np.uint16, n, pos + 6 * int(n))
    return high | low, keys[place]


def sharing(docs: DataFrame, id_col: str, text_col: str, width: int) -> DataFrame:
    """``run, key``: sets that share a signature have a run in common.

    Signatures travel packed by bucket to ``width`` tasks.  A task sends a set's
    signatures once, however many copies it holds; runs with the same members are one.
    """

    buckets = max(LEAST_BUCKETS, width)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sigs, owners, held, known = [], [], [], 0, {}

        def flush() -> Iterator[pa.RecordBatch]:
            sig, local = np.concatenate(sigs), np.concatenate(owners)
            bucket = ((sig & _U(0xFFFF_FFFF)) % _U(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            sig, local, bucket = sig[order], local[order], bucket[order]
            every, first = np.array(keys, _U), np.flatnonzero(np.diff(bucket, prepend=-1))
            for b, e in zip(first, np.append(first[1:], len(sig)), strict=True):
                blob = _pack(every, sig[b:e], local[b:e])
                yield pa.record_batch(
                    [pa.array([bucket[b]], pa.int32()), pa.array([blob], pa.binary())],
                    ["bucket", "blob"],
                )

        for batch in batches:
            for part in slices(batch, 1, _SLICE):
                found, at = shingle_sets(part.column(1), WIDTH)
                of = np.full(len(at) - 1, -1)
                for i, key in enumerate(set_keys(found, at).tolist()):
                    if key and key not in known:
                        known[key] = of[i] = len(keys)
                        keys.append(key)
                for sig, owner in signatures(found, at):
                    new = of[owner] >= 0
                    sigs.append(sig[new])
                    owners.append(of[owner][new])
                    held += len(sigs[-1])
                if held > _HELD or len(keys) > _DOCS:
                    yield from flush()
                    keys, sigs, owners, held, known = [], [], [], 0, {}
        if held:
            yield from flush()

    def meet(table: pa.Table) -> pa.Table:
        blobs = [_unpack(x.as_py()) for x in table.column("blob")]
        sig = np.concatenate([b[0] for b in blobs])
        key = np.concatenate([b[1] for b in blobs])
        order = np.lexsort((key, sig))
        sig, key = sig[order], key[order]
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (key[1:] != key[:-1])
        sig, key = sig[new], key[new]
        first = np.flatnonzero(np.diff(sig, prepend=~sig[:1]))
        size = np.diff(first, append=len(sig))
        name = mix(np.add.reduceat(mix(key), first) + size.astype(_U))
        several = np.flatnonzero(size > 1)
        _, chosen = np.unique(name[several], return_index=True)
        runs = several[chosen]
        member = np.repeat(first[runs] - (np.cumsum(size[runs]) - size[runs]), size[runs])
        member += np.arange(len(member))
        return pa.table({
            "run": np.repeat(name[runs], size[runs]).view(np.int64),
            "key": key[member].view(np.int64),
        })

    sent = _texts(docs, id_col, text_col).mapInArrow(send, "bucket int, blob binary")
    return (
        sent.repartition(width, "bucket")
        .groupBy("bucket").applyInArrow(meet, "run bigint, key bigint").distinct()
    )


def _fold(parity: list[bytes]) -> np.ndarray:
    """Maps as rows of 64-bit numbers, folded to the shortest of them."""
    width = min(map(len, parity))
    rows = np.empty((len(parity), width // 8), _U)
    for k, p in enumerate(parity):
        row = np.frombuffer(p, _U)
        while len(row) * 8 > width:
            row = row[: len(row) // 2] ^ row[len(row) // 2 :]
        rows[k] = row
    return rows


def _may(maps: np.ndarray, size: np.ndarray, one: int, rest: np.ndarray) -> np.ndarray:
    """Which of the rest the bitmaps and sizes let be similar to member ``one``."""
    differ = np.bitwise_count(maps[rest] ^ maps[one]).sum(1, dtype=np.int64)
    a, b = size[one], size[rest]
    return (9 * differ <= a + b) & (5 * np.minimum(a, b) >= 4 * np.maximum(a, b))


_PAIRS = "a bigint, b bigint"
_TRIES = "a bigint, b bigint, differ bigint"


def _middle(maps: np.ndarray) -> int:
    """The member whose map is closest to the majority of (up to 512) maps."""
    bits = np.unpackbits(maps[:512].view(np.uint8), axis=1)
    centre = np.packbits(2 * bits.sum(0, dtype=np.int64) > len(bits)).view(_U)
    return int(np.bitwise_count(maps ^ centre).sum(1, dtype=np.int64).argmin())


def _tries(table: pa.Table) -> pa.Table:
    """One try per member of a run: with the first hub that doesn't refuse it.

    Copies of one text with different edits are closer to that text than to each
    other, so the first hubs are the members in the middle of those that are left.
    """
    table = table.sort_by("key")
    key = table.column("key").to_numpy()
    size = table.column("n_shingles").to_numpy()
    maps = _fold(table.column("parity").to_pylist())
    rest, a, b, differ = np.arange(len(key)), [], [], []
    for turn in range(len(key)):
        if len(rest) < 2:
            break
        spot = _middle(maps[rest]) if turn < 8 and len(rest) > 2 else 0
        one, rest = rest[spot], np.delete(rest, spot)
        may = _may(maps, size, one, rest)
        a.append(np.full(may.sum(), key[one]))
        b.append(key[rest[may]])
        differ.append(np.bitwise_count(maps[rest[may]] ^ maps[one]).sum(1, dtype=np.int64))
        rest = rest[~may]
    return _pairs(a, b).append_column("differ", [np.concatenate(differ + [np.zeros(0, np.int64)])])


def _blocks(members: DataFrame, most: int) -> DataFrame:
    """``members`` with large runs replaced by runs of two blocks each; any two members
    of a run are together in one at least."""
    big = members.groupBy("run").agg(F.count("*").alias("size")).where(F.col("size") > most)
    parts = F.ceil(F.col("size") / most).cast("int")
    mine = F.pmod(F.xxhash64("key"), parts).cast("int")
    others = F.filter(F.sequence(F.lit(0), parts - 1), lambda j: j != mine)
    runs = F.when(F.col("size").isNull(), F.array("run")).otherwise(
        F.transform(others, lambda j: F.xxhash64("run", F.least(mine, j), F.greatest(mine, j)))
    )
    return (
        members.join(big, "run", "left").withColumn("runs", runs)
        .withColumn("run", F.explode("runs")).drop("runs", "size")
    )


def _star(members: DataFrame, most: int) -> DataFrame:
    """Members of large runs with the smallest member of their run: ``run, a, b`` and
    whether the two ``may`` be similar."""
    big = members.groupBy("run").agg(
        F.count("*").alias("size"), F.min(F.struct("key", "n_shingles", "parity")).alias("one")
    ).where(F.col("size") > most).select("run", "one")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.stack([batch.column(k).to_numpy() for k in (3, 5)])
            maps = [batch.column(k).to_pylist() for k in (4, 6)]
            may = [
                bool(_may(_fold([x, y]), size[:, k], 0, np.array([1]))[0])
                for k, (x, y) in enumerate(zip(*maps, strict=True))
            ]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(may, pa.bool_())],
                ["run", "a", "b", "may"],
            )

    rows = members.join(big, "run").where("key <> one.key").select(
        "run", F.col("one.key").alias("a"), F.col("key").alias("b"), "one.n_shingles", "one.parity",
        F.col("n_shingles").alias("n"), F.col("parity").alias("p"),
    )
    return rows.mapInArrow(compare, "run bigint, a bigint, b bigint, may boolean")


def _leftover(table: pa.Table) -> pa.Table:
    """All pairs of a run that may be similar and lie in different components."""
    table = table.sort_by("key")
    key, part = table.column("key").to_numpy(), table.column("component").to_numpy()
    if (part == part[0]).all():
        return _pairs([], [])
    size = table.column("n_shingles").to_numpy()
    maps = _fold(table.column("parity").to_pylist())
    a, b = [], []
    for one in range(len(key) - 1):
        rest = np.arange(one + 1, len(key))
        rest = rest[part[rest] != part[one]]
        rest = rest[_may(maps, size, one, rest)]
        a.append(np.full(len(rest), key[one]))
        b.append(key[rest])
    return _pairs(a, b)


def _pairs(a: list[np.ndarray], b: list[np.ndarray]) -> pa.Table:
    empty = [np.zeros(0, np.int64)]
    return pa.table({"a": np.concatenate(a + empty), "b": np.concatenate(b + empty)})


def _sets(docs: DataFrame, id_col: str, text_col: str, ids: DataFrame) -> DataFrame:
    """``key, members``: the shingles of the documents with these ids.

    The ids are one for each set, so a set comes once, or as often as a row is repeated.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, _SLICE):
                found, at = shingle_sets(part.column(1), WIDTH)
                packed = [found[b:e].tobytes() for b, e in zip(at[:-1], at[1:], strict=True)]
                yield pa.record_batch(
                    [pa.array(set_keys(found, at).view(np.int64)), pa.array(packed, pa.binary())],
                    ["key", "members"],
                )

    texts = _texts(docs, id_col, text_col)
    wanted = sent_if_few(ids.select(F.col("doc_id").alias("want")).distinct(), "wanted")
    texts = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("want")), "left_semi")
    return texts.mapInArrow(rows, "key bigint, members binary")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets are similar, counted on the sets."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for k in range(batch.num_rows):
                a = np.frombuffer(batch.column(2)[k].as_buffer(), _U)
                b = np.frombuffer(batch.column(3)[k].as_buffer(), _U)
                both = np.concatenate([a, b])
                both.sort()
                good[k] = similar(len(a), len(b), int((both[1:] == both[:-1]).sum()))
            yield batch.select(["a", "b"]).filter(pa.array(good))

    # Only sets that a pair names are moved.
    sides = {}
    for side in "ab":
        named = sent_if_few(pairs.select(F.col(side).alias("key")).distinct(), "named")
        sides[side] = sets.join(named, "key", "left_semi")
    left = sides["a"].select(F.col("key").alias("a"), F.col("members").alias("x"))
    right = sides["b"].select(F.col("key").alias("b"), F.col("members").alias("y"))
    rows = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return rows.mapInArrow(keep, _PAIRS)


def _apart(pairs: DataFrame, linked: DataFrame) -> DataFrame:
    """The pairs whose two sets are in different components."""
    a, b = (linked.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}")) for c in "ab")
    known = pairs.join(a, "a", "left").join(b, "b", "left")
    same = F.coalesce("of_a", "a") == F.coalesce("of_b", "b")
    return known.where(~same).select("a", "b")


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every document; see the module's text."""
    spark = docs.sparkSession
    described = stored(describe(docs, id_col, text_col), "described")
    distinct = described.where("key <> 0").groupBy("key").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"),
        F.first("n_shingles").alias("n_shingles"), F.first("parity").alias("parity"),
    )
    width = width_for(spark, described.count(), DOCS_A_TASK)
    runs = stored(sharing(docs, id_col, text_col, width), "runs")
    members = stored(runs.join(distinct.drop("copies"), "key"), "members")
    large = not runs.groupBy("run").count().where(F.col("count") > MOST).isEmpty()
    members = members.select("run", "key", "doc_id", "n_shingles", "parity")
    tries = members
    if large:
        star = stored(_star(members, MOST), "star")
        settled = star.where("may").select("run", F.col("b").alias("key"))
        tries = _blocks(members.join(settled, ["run", "key"], "left_anti"), MOST)
    tries = tries.select("run", "key", "n_shingles", "parity").repartition(width, "run").groupBy("run")
    tries = tries.applyInArrow(_tries, _TRIES)
    if large:
        tries = tries.unionByName(star.where("may").select("a", "b", F.lit(0).cast("bigint").alias("differ")))
    tries = stored(tries.groupBy("a", "b").agg(F.min("differ").alias("differ")), "tries")
    sets = stored(_sets(docs, id_col, text_col, members), "sets")
    closest = F.min(F.struct("differ", "a"))["a"]
    first = stored(tries.groupBy("b").agg(closest.alias("a")).select("a", "b"), "first")
    links = stored(_verified(first, sets), "links")
    linked = sent_if_few(components(links), "linked")
    second = stored(_apart(tries, linked).join(first, ["a", "b"], "left_anti"), "second")
    found = stored(_verified(second, sets), "links")
    if not found.isEmpty():
        links = links.unionByName(found)
        linked = sent_if_few(components(links), "linked")
    # Members that the tries left apart although they may be similar.
    parts = members.join(linked, members["key"] == linked["node"], "left").select(
        "run", "key", "n_shingles", "parity", F.coalesce("component", "key").alias("component")
    )
    more = stored(
        (_blocks(parts, MOST) if large else parts).repartition(width, "run").groupBy("run")
        .applyInArrow(_leftover, _PAIRS).distinct().join(tries, ["a", "b"], "left_anti"), "more",
    )
    found = stored(_verified(more, sets), "links")
    if not found.isEmpty():
        linked = stored(components(links.unionByName(found)), "linked")
    linked = linked.join(distinct.select(F.col("key").alias("node"), "doc_id"), "node")
    names = linked.groupBy("component").agg(F.min("doc_id").alias("name"))
    by_key = (
        distinct.select("key", "doc_id", "copies")
        .join(linked.select(F.col("node").alias("key"), "component"), "key", "left")
        .join(names, "component", "left")
        .where("copies > 1 or component is not null")
        .select("key", F.coalesce("name", "doc_id").alias("name"))
    )
    return described.join(by_key, "key", "left").select(
        "doc_id", "n_shingles", F.coalesce("name", "doc_id").alias("component_id")
    )

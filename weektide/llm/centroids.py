"""Centroid clustering in whole numbers, over blocks of vectors along a Hilbert curve.

Every component becomes ``floor(scale * component)``.  Vectors are put in the order of a
Hilbert curve over a grid (dimensions by falling spread, four bits each), cut into blocks
of ``BLOCK`` vectors, and written with each block's box: the least and the largest value
of every dimension, and its sums.  In a round the distances from a box to the centroids
give bounds for all its vectors: a centroid that is farther from the box than another is
from its farthest corner cannot be nearest.  A block left with one candidate adds its
sums; the vectors of others are compared with the candidates, exactly, in NumPy.

The first centroids are the kept vectors with the smallest SHA-256 of ``seed:id``, in that
order.  Ties of distance go to the smaller number, a new centroid is the exact floor of
sum over count, and an empty one stays.  All sums are whole numbers, so the result does
not depend on how rows are spread.

What the driver holds is bounded by centroids x dimensions.  Blocks are dealt out by
ranges of the curve, and rows of one place are told apart by their number, so a vector
that a third of all rows share is spread like any other.

Defined results: rows whose vector is NULL, has another number of components, or a NULL
or non-finite one are left out; repeated rows and ids count each; a NULL id is kept, and
hashed as an empty one; fewer vectors than centroids give as many centroids as vectors;
an empty table gives no rows; other columns are not looked at.  Components too large for
squared distances of 64 bits are an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weektide.llm.store import stored

#: Components of a vector, their scale, centroids, rounds, and the seed of the first ones.
DIMS, SCALE, CENTROIDS, ROUNDS, SEED = 64, 1024, 8, 10, 3
#: Vectors of a block.
BLOCK = 64
#: Bits of the curve's grid in each dimension.
BITS = 4
#: Vectors of a shuffle task: at most, and at least while cores are free.
_MOST, _LEAST = 100_000, 2_048

ASSIGNED = "vec_id bigint, cluster int, distance bigint"


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str, dims: int, scale: int) -> DataFrame:
    """``vec_id`` and the whole numbers ``x`` of vectors that are complete and finite."""
    most = math.isqrt((1 << 62) // max(dims, 1)) // 2

    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf))

    def whole(c: Column) -> Column:
        at = F.floor(c * scale)
        return F.when(F.abs(c * scale) < most, at).otherwise(
            F.raise_error(F.lit("a component is too large for squared distances of 64 bits"))
        )

    rows = vectors.select(
        F.col(f"`{id_col}`").cast("bigint").alias("vec_id"),
        F.col(f"`{vec_col}`").cast("array<double>").alias("v"),
    )
    kept = rows.where((F.size("v") == dims) & F.forall("v", finite))
    return kept.select("vec_id", F.transform("v", whole).alias("x"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places along a Hilbert curve of grid cells (dimensions x cells), as rows of bytes.

    After J. Skilling, Programming the Hilbert curve (2004): undo the excess work of each
    level from the highest bit down, then take the Gray code over all dimensions.
    """
    x = cells.astype(np.uint8).copy()
    for level in range(bits - 1, 0, -1):
        below = np.uint8((1 << level) - 1)
        for row in x:
            high = (row >> np.uint8(level)) & np.uint8(1) == 1
            swap = np.where(high, np.uint8(0), (x[0] ^ row) & below)
            x[0] ^= swap
            row ^= swap
            x[0] ^= np.where(high, below, np.uint8(0))
    np.bitwise_xor.accumulate(x, axis=0, out=x)
    last, turn = x[-1].copy(), np.zeros(x.shape[1], np.uint8)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((last >> np.uint8(level)) & 1 == 1, np.uint8((1 << level) - 1), np.uint8(0))
    x ^= turn
    planes = [(x >> np.uint8(level)) & 1 for level in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T, axis=1)


def _spread(vectors: DataFrame, dims: int) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Number of vectors; least and largest value of every dimension, and their order."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares, low, high = 0, 0, 0, np.inf, -np.inf
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0), dims).astype(float)
                n += len(x)
                sums, squares = sums + x.sum(0), squares + (x * x).sum(0)
                low, high = np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
        if n:
            yield pa.record_batch(
                [pa.array(np.arange(dims)), pa.array(np.full(dims, n)), *map(pa.array, (sums, squares, low, high))],
                ["d", "n", "s", "q", "low", "high"],
            )

    found = (
        vectors.select("x").mapInArrow(measure, "d bigint, n bigint, s double, q double, low double, high double")
        .groupBy("d").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("q").alias("q"),
                          F.min("low").alias("low"), F.max("high").alias("high"))
        .orderBy("d").toPandas()
    )
    if not len(found):
        none = np.zeros(dims)
        return 0, none, none, np.arange(dims)
    n = int(found.n[0])
    order = np.argsort(-(found.q / n - (found.s / n) ** 2).to_numpy(), kind="stable")
    return n, found.low.to_numpy(), found.high.to_numpy(), order


_BLOCKS = "ids array<bigint>, x binary, low binary, high binary, sums binary"


def blocks_of(vectors: DataFrame, dims: int, block: int = BLOCK) -> tuple[DataFrame, int]:
    """The blocks of ``vectors`` (see the module's text), stored, and the number of vectors."""
    n, low, high, order = _spread(vectors, dims)
    step = np.maximum(high - low, 1)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dims)
            cells = ((x - low) / step * ((1 << BITS) - 1e-9)).astype(np.uint8)
            keys = hilbert_keys(cells.T[order])
            rows = np.ascontiguousarray(x.astype("<i8"))
            yield pa.record_batch(
                [pa.array([k.tobytes() for k in keys], pa.binary()), batch.column(0),
                 pa.array([r.tobytes() for r in rows], pa.binary())], ["key", "vec_id", "x"],
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def made(part: pa.Table) -> pa.RecordBatch:
            ids = part.column("vec_id").combine_chunks()
            x = np.frombuffer(b"".join(part.column("x").to_pylist()), "<i8").reshape(-1, dims)
            rows = []
            for at in range(0, len(x), block):
                some = x[at : at + block]
                rows.append((
                    ids.slice(at, block).to_pylist(), some.tobytes(),
                    *(a.astype("<i8").tobytes() for a in (some.min(0), some.max(0), some.sum(0))),
                ))
            columns = list(zip(*rows, strict=True))
            return pa.record_batch(
                [pa.array(columns[0], pa.list_(pa.int64())), *(pa.array(c, pa.binary()) for c in columns[1:])],
                ["ids", "x", "low", "high", "sums"],
            )

        for batch in batches:
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            whole = held.num_rows - held.num_rows % block
            if whole:
                yield made(held.slice(0, whole))
                held = held.slice(whole)
        if held is not None and held.num_rows:
            yield made(held)

    cores = vectors.sparkSession.sparkContext.defaultParallelism
    width = max(-(-n // _MOST), min(cores, -(-n // _LEAST)), 1)
    along = (
        vectors.select("vec_id", "x").mapInArrow(keyed, "key binary, vec_id bigint, x binary")
        .withColumn("nth", F.monotonically_increasing_id())
        .repartitionByRange(width, "key", "nth").sortWithinPartitions("key", "nth")
    )
    return stored(along.select("vec_id", "x").mapInArrow(cut, _BLOCKS), "blocks"), n


def first_centroids(vectors: DataFrame, centroids: int, seed: int) -> np.ndarray:
    """The vectors with the smallest hashes of seed and id, in that order."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    rows = vectors.orderBy(F.sha2(text, 256), "x").limit(centroids).select("x").collect()
    return np.array([r.x for r in rows], np.int64)


def nearest(batch: pa.RecordBatch, centroids: np.ndarray) -> Iterator[tuple[int, np.ndarray | None, np.ndarray, list[int]]]:
    """Of every block (columns low, high, x): its row, and who is nearest.

    Either the one candidate that its box leaves, or the vectors with their distances to
    the candidates.  The box gives a least and a largest squared distance to every centroid.
    """
    dims = centroids.shape[1]
    low, high = (
        np.frombuffer(b"".join(batch.column(k).to_pylist()), "<i8").reshape(-1, 1, dims) for k in ("low", "high")
    )
    under, over = low - centroids, centroids - high
    least = (np.maximum(np.maximum(under, over), 0) ** 2).sum(2)
    most = (np.maximum(np.abs(under), np.abs(over)) ** 2).sum(2)
    may = least <= most.min(1, keepdims=True)
    for row in range(batch.num_rows):
        chosen = np.flatnonzero(may[row])
        if len(chosen) == 1:
            yield row, None, chosen, []
        else:
            x = np.frombuffer(batch.column("x")[row].as_py(), "<i8").reshape(-1, dims)
            yield row, x, chosen, ((x[:, None, :] - centroids[chosen]) ** 2).sum(2)


def _moved(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    dims = centroids.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for batch in batches:
            total = np.frombuffer(b"".join(batch.column("sums").to_pylist()), "<i8").reshape(-1, dims)
            for row, x, chosen, far in nearest(batch, centroids):
                if x is None:
                    sums[chosen[0]] += total[row]
                    counts[chosen[0]] += batch.column("n")[row].as_py()
                    continue
                to = chosen[far.argmin(1)]
                counts += np.bincount(to, minlength=len(centroids))
                for c in chosen:
                    sums[c] += x[to == c].sum(0)
        some = np.flatnonzero(counts)
        yield pa.record_batch(
            [pa.array(np.repeat(some, dims)), pa.array(np.tile(np.arange(dims), len(some))),
             pa.array(np.repeat(counts[some], dims)), pa.array(sums[some].ravel())],
            ["cluster", "d", "n", "s"],
        )

    parts = blocks.select("x", "low", "high", "sums", F.size("ids").alias("n")).mapInArrow(
        add, "cluster bigint, d bigint, n bigint, s bigint"
    )
    found = parts.groupBy("cluster", "d").agg(
        F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")
    )
    out = centroids.copy()
    for r in found.collect():
        out[r.cluster, r.d] = int(r.s) // r.n
    return out


def _assigned(blocks: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Every vector with its cluster and squared distance."""
    dims = centroids.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, x, chosen, far in nearest(batch, centroids):
                if x is None:
                    x = np.frombuffer(batch.column("x")[row].as_py(), "<i8").reshape(-1, dims)
                    to, distance = np.full(len(x), chosen[0]), ((x - centroids[chosen[0]]) ** 2).sum(1)
                else:
                    best = far.argmin(1)
                    to, distance = chosen[best], far[np.arange(len(x)), best]
                yield pa.record_batch(
                    [pa.array(batch.column("ids")[row].as_py(), pa.int64()), pa.array(to.astype(np.int32)),
                     pa.array(distance)], ["vec_id", "cluster", "distance"],
                )

    return blocks.select("ids", "x", "low", "high").mapInArrow(assign, ASSIGNED)


def cluster(
    vectors: DataFrame, id_col: str, vec_col: str, centroids: int = CENTROIDS, rounds: int = ROUNDS,
    dims: int = DIMS, scale: int = SCALE, seed: int = SEED, block: int = BLOCK,
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id``, ``cluster`` and squared ``distance`` of every kept vector, and the final centroids."""
    if dims < 1 or centroids < 1:
        raise ValueError("at least one dimension and one centroid")
    whole = whole_vectors(vectors, id_col, vec_col, dims, scale)
    places = first_centroids(whole, centroids, seed)
    if not len(places):
        return vectors.sparkSession.createDataFrame([], ASSIGNED), places.reshape(0, dims)
    blocks, _ = blocks_of(whole, dims, block)
    for _ in range(rounds):
        moved = _moved(blocks, places)
        if (moved == places).all():
            break  # every further round gives the same
        places = moved
    return _assigned(blocks, places), places


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Assigned vectors with the inertia of their cluster and of all, and their centroid's digest."""
    spark = assigned.sparkSession
    assigned = stored(assigned, "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    total = sum(int(r.s) for r in sums)
    # One row a centroid.
    rows = [
        (int(r.cluster), int(r.s), total, ",".join(str(v) for v in centroids[r.cluster])) for r in sums
    ]
    told = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, components string")
    return assigned.join(F.broadcast(told), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2("components", 256).alias("centroid_sha256"),
    )

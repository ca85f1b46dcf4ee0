"""Whitening of vectors with distributed block matrices.

Every component becomes ``floor(scale * component)``.  The statistics are those of the
distinct whole vectors (the fit list): sums, and the scatter of the centred rows as the
product of their block matrix, transposed, with itself.  Its eigenvectors, found locally
(dimensions x dimensions numbers), divided by the roots of their eigenvalues, make the
whitening matrix; multiplying the block matrix of all centred rows by it projects them.

Rows are cut into blocks where they are read; a block gets its number from a count of
blocks for each task, so nothing is shuffled to index rows, and the last block of a task
is filled up with zeros, which add nothing to a scatter.  Blocks are stored as whole
numbers of the least width and become matrices of doubles on their way into a product.
The middle dimension of the scatter product is as long as the table, so it is cut into
splits that are summed up: no task gets more than some blocks.  A vector that many rows
share is one row of the fit list, found by a combined aggregate; results come back by
block number, so such a vector is no hot key.  The driver holds one key for each block
of rows, and the scatter.

Defined results: rows whose vector is NULL or holds a NULL or non-finite entry are left
out; a shorter vector counts as filled up with zeros; repeated rows and NULL ids get rows
of their own.  With fewer dimensions than ``components`` there are as many components as
dimensions.  A component without spread (its eigenvalue is below 1e-12 of the largest, or
all are zero) has NULL for ``whitened`` and is left out of ``identity_error``; with no
spread at all ``explained`` is 0 and ``identity_error`` 0.  A ``deviation`` beyond 64 bits
is NULL.  An empty table, or only empty vectors, give no rows.  Other columns are not
looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix, MatrixUDT
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weektide.llm.store import stored

#: Scale of whole numbers, and components asked for.
SCALE, COMPONENTS = 256, 4
#: Rows of a block, and blocks that one split of a product multiplies.
BLOCK_ROWS, SPLIT_BLOCKS = 1024, 16
#: Eigenvalues below this part of the largest count as none.
NO_SPREAD = 1e-12

WHITENED = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
    "explained double, identity_error double"
)
_CUT = "part int, nth int, ids array<bigint>, width int, x binary"
_MATRICES = T.StructType([
    T.StructField("blockRowIndex", T.LongType()), T.StructField("blockColIndex", T.LongType()),
    T.StructField("subMatrix", MatrixUDT()),
])


@dataclass(frozen=True)
class Whitening:
    """What is learned from the fit list: ``matrix`` has a column for each component."""

    n: int
    sums: list[int]
    matrix: np.ndarray
    explained: np.ndarray
    spread: np.ndarray


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and the whole numbers ``x`` of vectors without NULL or non-finite entries."""
    def finite(c: Column) -> Column:
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf))

    rows = vectors.select(
        F.col(f"`{id_col}`").cast("bigint").alias("vec_id"),
        F.col(f"`{vec_col}`").cast("array<double>").alias("v"),
    )
    return rows.where(F.col("v").isNotNull() & F.forall("v", finite)).select(
        "vec_id", F.transform("v", lambda c: F.floor(c * scale).cast("bigint")).alias("x")
    )


def _packed(x: np.ndarray) -> tuple[int, bytes]:
    """Whole numbers in the least width, and that width."""
    most = int(max(-int(x.min()), int(x.max()) + 1)) if x.size else 0
    width = next(w for w in (1, 2, 4, 8) if most <= 1 << (8 * w - 1))
    return width, x.astype(f"<i{width}").tobytes()


def _unpacked(batch: pa.RecordBatch, row: int, dims: int) -> np.ndarray:
    width, raw = batch.column("width")[row].as_py(), batch.column("x")[row].as_py()
    return np.frombuffer(raw, f"<i{width}").reshape(-1, dims).astype(np.int64)


def blocks_of(rows: DataFrame, dims: int) -> tuple[DataFrame, int]:
    """Stored blocks of rows (id, vector), as number ``block``, ids and packed ``x``, and how many."""
    spark, size = rows.sparkSession, BLOCK_ROWS

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, nth, held, ids, there = TaskContext.get().partitionId(), 0, [], [], 0

        def made(n: int) -> pa.RecordBatch:
            nonlocal held, ids, there, nth
            x, of = np.concatenate(held), pa.concat_arrays(ids)
            width, raw = _packed(x[:n])
            held, ids, there, nth = [x[n:]], [of.slice(n)], there - n, nth + 1
            return pa.RecordBatch.from_pylist(
                [{"part": part, "nth": nth - 1, "ids": of.slice(0, n).to_pylist(), "width": width, "x": raw}],
                pa.schema([("part", pa.int32()), ("nth", pa.int32()), ("ids", pa.list_(pa.int64())),
                           ("width", pa.int32()), ("x", pa.binary())]),
            )

        for batch in batches:
            held.append(batch.column(1).flatten().to_numpy().reshape(-1, dims))
            ids.append(batch.column(0))
            there += batch.num_rows
            while there >= size:
                yield made(size)
        if there:
            yield made(there)

    found = stored(rows.mapInArrow(cut, _CUT), "blocks")
    offsets, total = [], 0
    for r in found.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():
        offsets.append((r.part, total))
        total += r.n
    # One row for each task that wrote blocks.
    starts = spark.createDataFrame(offsets, "part int, start int")
    return found.join(F.broadcast(starts), "part").select(
        (F.col("start") + F.col("nth")).alias("block"), "ids", "width", "x"
    ), total


def rows_of(blocks: DataFrame, dims: int) -> DataFrame:
    """A row for each vector of ``blocks``: its number and ``x``."""
    size = BLOCK_ROWS

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                x = _unpacked(batch, k, dims)
                lists = pa.ListArray.from_arrays(np.arange(0, x.size + 1, dims, dtype=np.int32), x.ravel())
                first = batch.column("block")[k].as_py() * size
                yield pa.record_batch([pa.array(np.arange(first, first + len(x))), lists], ["row", "x"])

    return blocks.select("block", "width", "x").mapInArrow(each, "row bigint, x array<bigint>")


def block_matrix(blocks: DataFrame, count: int, n: int, sums: list[int]) -> BlockMatrix:
    """The block matrix of the centred rows of ``count`` blocks."""
    size, mean, dims = BLOCK_ROWS, np.array([s / n for s in sums]), len(sums)
    kind = pa.struct([
        ("type", pa.int8()), ("numRows", pa.int32()), ("numCols", pa.int32()), ("colPtrs", pa.list_(pa.int32())),
        ("rowIndices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64())), ("isTransposed", pa.bool_()),
    ])

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                x = _unpacked(batch, k, dims)
                full = np.zeros((size, dims), order="F")
                full[: len(x)] = x - mean
                for j in range(0, dims, size):
                    part = full[:, j : j + size]
                    values = pa.ListArray.from_arrays(np.array([0, part.size], np.int32), part.ravel(order="F"))
                    none = pa.array([None], pa.list_(pa.int32()))
                    fields = [pa.array([1], pa.int8()), pa.array([size], pa.int32()),
                              pa.array([part.shape[1]], pa.int32()), none, none, values, pa.array([False])]
                    yield pa.record_batch(
                        [pa.array([batch.column("block")[k].as_py()], pa.int64()), pa.array([j // size], pa.int64()),
                         pa.StructArray.from_arrays(fields, fields=list(kind))],
                        ["blockRowIndex", "blockColIndex", "subMatrix"],
                    )

    ready = blocks.select("block", "width", "x").mapInArrow(matrices, _MATRICES).select(
        F.struct("blockRowIndex", "blockColIndex"), "subMatrix"
    )
    # From table to matrix within the JVM.
    return BlockMatrix(callMLlibFunc("createBlockMatrix", ready, size, size, count * size, dims), size, size)


def multiply(left: BlockMatrix, right: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """The product; the middle dimension is cut into ``splits`` parts that are summed."""
    a, b = left._java_matrix_wrapper, right._java_matrix_wrapper
    return BlockMatrix(a.call("multiply", b._java_model, splits), left.rowsPerBlock, right.colsPerBlock)


def _small_matrix(spark, values: np.ndarray) -> BlockMatrix:
    """A matrix of the driver as blocks: at most dimensions x components numbers."""
    rows, cols = values.shape
    blocks = [
        ((i // BLOCK_ROWS, 0), DenseMatrix(len(part), cols, part.ravel(order="F")))
        for i in range(0, rows, BLOCK_ROWS) for part in [values[i : i + BLOCK_ROWS]]
    ]
    return BlockMatrix(spark.sparkContext.parallelize(blocks, 1), BLOCK_ROWS, BLOCK_ROWS, rows, cols)


def _totals(blocks: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of every dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * dims
        for batch in batches:
            for k in range(batch.num_rows):
                x = _unpacked(batch, k, dims)
                small = np.abs(x).max(initial=0) < 1 << 50
                sums = [a + int(b) for a, b in zip(sums, x.sum(0) if small else x.astype(object).sum(0), strict=True)]
                n += len(x)
        yield pa.record_batch(
            [pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()),
             pa.array([Decimal(s) for s in sums], pa.decimal128(38))], ["d", "n", "s"],
        )

    parts = blocks.select("width", "x").mapInArrow(add, "d int, n bigint, s decimal(38,0)")
    found = parts.groupBy("d").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("d").collect()
    return found[0].n, [int(r.s) for r in found]


def fit(distinct: DataFrame, count: int, dims: int, components: int = COMPONENTS) -> Whitening:
    """The whitening learned from the blocks of distinct vectors of ``dims`` entries."""
    n, sums = _totals(distinct, dims)
    rows = block_matrix(distinct, count, n, sums)
    splits = max(1, count // SPLIT_BLOCKS)
    scatter = multiply(rows.transpose(), rows, splits).toLocalMatrix().toArray()
    values, vectors = np.linalg.eigh((scatter + scatter.T) / (2 * n))
    values, vectors = np.maximum(values[::-1], 0), vectors[:, ::-1]
    trace, k = values.sum(), min(components, dims)
    spread = values[:k] > NO_SPREAD * values[0]
    roots = np.sqrt(np.where(spread, values[:k], 1))
    matrix = np.where(spread, vectors[:, :k] / roots, 0.0)
    return Whitening(n, sums, matrix, values[:k] / trace if trace > 0 else np.zeros(k), spread)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of ``(n x - S)^2`` of every row; NULL beyond 64 bits."""
    most = n * int(max(-int(x.min(initial=0)), int(x.max(initial=0)))) + max(map(abs, sums))
    if most * most * len(sums) < 1 << 63:
        return ((n * x - np.array(sums)) ** 2).sum(1).tolist()
    exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(1)
    return [int(v) if v < 1 << 63 else None for v in exact]


def project(blocks: DataFrame, count: int, learned: Whitening) -> DataFrame:
    """``row``, ``vec_id``, ``deviation`` and projections ``w`` of every vector of ``blocks``."""
    size, dims, n, sums = BLOCK_ROWS, len(learned.sums), learned.n, learned.sums
    rows = block_matrix(blocks, count, n, sums)
    product = multiply(rows, _small_matrix(blocks.sparkSession, learned.matrix))
    found = callMLlibFunc("getMatrixBlocks", product._java_matrix_wrapper._java_model).select(
        F.col("_1._1").cast("int").alias("block"), F.col("_2").alias("subMatrix")
    )

    def told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = [_unpacked(batch, k, dims) for k in range(batch.num_rows)]
            yield pa.record_batch(
                [batch.column("block"), batch.column("ids"),
                 pa.array([_deviations(v, n, sums) for v in x], pa.list_(pa.int64()))],
                ["block", "ids", "deviations"],
            )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                ids = pa.array(batch.column("ids")[k].as_py(), pa.int64())
                deviations = pa.array(batch.column("deviations")[k].as_py(), pa.int64())
                matrix = batch.column("subMatrix").field("values")[k].values.to_numpy()
                turned = batch.column("subMatrix").field("isTransposed")[k].as_py()
                w = np.ascontiguousarray(matrix.reshape((size, -1), order="C" if turned else "F")[: len(ids)])
                lists = pa.ListArray.from_arrays(
                    np.arange(0, w.size + 1, w.shape[1], dtype=np.int32), w.ravel()
                )
                first = batch.column("block")[k].as_py() * size
                yield pa.record_batch(
                    [pa.array(np.arange(first, first + len(ids))), ids, deviations, lists],
                    ["row", "vec_id", "deviation", "w"],
                )

    sized = blocks.mapInArrow(told, "block int, ids array<bigint>, deviations array<bigint>")
    return sized.join(found, "block").select("block", "ids", "deviations", "subMatrix").mapInArrow(
        each, "row bigint, vec_id bigint, deviation bigint, w array<double>"
    )


def _identity_error(projected: DataFrame, spread: np.ndarray) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    used = np.flatnonzero(spread)
    pairs = [(int(a), int(b)) for a in used for b in used if a <= b]
    if not pairs:
        return 0.0
    got = projected.agg(*[
        F.covar_pop(F.get("w", F.lit(a)), F.get("w", F.lit(b))).alias(f"c{a}_{b}") for a, b in pairs
    ]).first()
    return max(abs(got[f"c{a}_{b}"] - (a == b)) for a, b in pairs)


def whiten(
    vectors: DataFrame, id_col: str, vec_col: str, components: int = COMPONENTS, scale: int = SCALE
) -> DataFrame:
    """A row for every vector and component; see the module's text and ``WHITENED``."""
    spark = vectors.sparkSession
    whole = whole_vectors(vectors, id_col, vec_col, scale)
    sizes = whole.agg(F.max(F.size("x")).alias("most"), F.min(F.size("x")).alias("least")).first()
    dims = sizes.most or 0
    if not dims or components < 1:
        return spark.createDataFrame([], WHITENED)
    if sizes.least < dims:
        filler = F.array_repeat(F.lit(0).cast("bigint"), dims - F.size("x"))
        whole = whole.withColumn("x", F.concat("x", filler))
    blocks, count = blocks_of(whole, dims)
    firsts = rows_of(blocks, dims).groupBy("x").agg(F.min("row").alias("of"))
    distinct, unlike = blocks_of(firsts.select("of", "x"), dims)
    learned = fit(distinct, unlike, dims, components)
    projected = stored(project(blocks, count, learned), "projected")
    fitted = distinct.select(F.explode("ids").alias("row"))
    error = _identity_error(projected.join(fitted, "row"), learned.spread)
    parts = F.array(*[
        F.struct(
            F.lit(k + 1).alias("component"),
            (F.get("w", F.lit(k)) if learned.spread[k] else F.lit(None).cast("double")).alias("whitened"),
            F.lit(float(learned.explained[k])).alias("explained"),
        )
        for k in range(len(learned.spread))
    ])
    return projected.select("vec_id", "deviation", F.explode(parts).alias("p")).select(
        "vec_id", "p.component", F.lit(learned.n).cast("bigint").alias("n"), "deviation",
        "p.whitened", "p.explained", F.lit(float(error)).alias("identity_error"),
    )

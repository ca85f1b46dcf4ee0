"""Whitening against a plain version."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from weektide.llm import whitening as M

SCHEMA = "vec_id long, v array<float>, row string, x string, w string, part string, nth string"


def table(spark, rows):
    rows = [(i, v and [c if c is None else float(c) for c in v]) for i, v in rows]
    return spark.createDataFrame([(i, v, *["?"] * 5) for i, v in rows], SCHEMA)


def plain(rows, components=4):
    """Expected n, deviations by (id, vector), eigenvalues and the projections' absolute values."""
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    dims = max(len(x) for _, x in kept)
    kept = [(i, x + [0] * (dims - len(x))) for i, x in kept]
    fit = sorted({tuple(x) for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    centred = np.array(fit, float) - np.array(sums) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    out = []
    for i, x in kept:
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        for k in range(min(components, dims)):
            some = values[k] > 1e-12 * values[0] and values[0] > 0
            white = (np.array(x) - np.array(sums) / n) @ vectors[:, k] / math.sqrt(values[k]) if some else None
            out.append((i, k + 1, n, deviation, white, values[k] / max(values.sum(), 1e-300)))
    return out


def check(spark, rows):
    got = M.whiten(table(spark, rows).repartition(3), "vec_id", "v").collect()
    want = plain(rows)
    key = lambda r: (r[1], r[0] is None, r[0] or 0, r[3])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    for k in {g[1] for g in got}:
        a = [(g[4], w[4]) for g, w in zip(got, want, strict=True) if g[1] == k]
        if a[0][1] is None:
            assert all(g is None for g, _ in a)
            continue
        a = np.array(a, float)
        sign = np.sign((a[:, 0] * a[:, 1]).sum())
        np.testing.assert_allclose(a[:, 0], sign * a[:, 1], rtol=1e-6, atol=1e-8)
    np.testing.assert_allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9, atol=1e-12)
    assert len({g[6] for g in got}) <= 1 and all(abs(g[6]) < 1e-9 for g in got)
    return got


def cloud(n, dims, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)) * np.linspace(1, 3, dims) + 0.5
    return [(int(i), [float(c) for c in v]) for i, v in enumerate(x.astype(np.float32))]


def test_cloud(spark):
    check(spark, cloud(300, 7))


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK_ROWS", 16)
    monkeypatch.setattr(M, "SPLIT_BLOCKS", 2)
    check(spark, cloud(250, 20, 1))


def test_rows_of_any_kind(spark):
    rows = cloud(40, 5, 2)
    nan, inf = float("nan"), float("inf")
    rows += [(None, rows[0][1]), (3, rows[0][1]), (3, rows[0][1]), (50, None), (51, [nan] * 5), (52, [1.0, inf]),
             (53, [1.0, None, 0, 0, 0]), (54, []), (55, [2.0])] + [(60, rows[1][1])] * 30
    check(spark, rows)


@pytest.mark.parametrize("rows", [
    [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [1.0]), (2, [2.0]), (3, [4.5])],
    [(1, [1.0, 1.0, 0.0]), (2, [2.0, 2.0, 0.0]), (3, [5.0, 5.0, 0.0])],
])
def test_little_spread(spark, rows):
    check(spark, rows)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])]])
def test_nothing(spark, rows):
    assert M.whiten(table(spark, rows), "vec_id", "v").collect() == []


def test_deviation_beyond_64_bits_is_null(spark):
    rows = [(k, [1e13 * k, float(k)]) for k in range(5)]
    got = M.whiten(spark.createDataFrame(rows, "vec_id long, v array<double>"), "vec_id", "v")
    assert got.where("deviation is null").count() > 0 and got.where(F.col("whitened").isNull()).count() in (0, 5)


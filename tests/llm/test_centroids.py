"""Centroid clustering against a plain version."""

import hashlib
import math

import numpy as np
import pytest

from weektide.llm import centroids as C

SCHEMA = "vec_id long, v array<float>, x string, key string, nth string, cluster string, ids string"


def table(spark, rows):
    rows = [(i, v and [c if c is None else float(c) for c in v]) for i, v in rows]
    return spark.createDataFrame([(i, v, *["?"] * 5) for i, v in rows], SCHEMA)


def plain(rows, dims, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * float(np.float32(c))) for c in v]) for i, v in rows
            if v is not None and len(v) == dims and all(c is not None and math.isfinite(c) for c in v)]
    text = lambda i: "3:" + ("" if i is None else str(i))
    order = sorted(kept, key=lambda r: (hashlib.sha256(text(r[0]).encode()).hexdigest(), r[1]))
    places = [list(x) for _, x in order[:k]]

    def near(x):
        far = [sum((a - b) ** 2 for a, b in zip(x, p, strict=True)) for p in places]
        return min(range(len(far)), key=far.__getitem__), min(far)

    for _ in range(rounds):
        members = {}
        for _, x in kept:
            members.setdefault(near(x)[0], []).append(x)
        for c, some in members.items():
            places[c] = [sum(v) // len(some) for v in zip(*some, strict=True)]
    return [(i, *near(x)) for i, x in kept], places


def check(spark, rows, dims, **more):
    found, places = C.cluster(table(spark, rows).repartition(3), "vec_id", "v", dims=dims, **more)
    want, expected = plain(rows, dims, more.get("centroids", 8), more.get("rounds", 10))
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
    assert sorted(map(tuple, found.collect()), key=key) == sorted(want, key=key)
    assert places.tolist() == expected
    out = C.with_inertia(found, places).collect()
    assert {r.inertia for r in out} <= {sum(d for *_, d in want)}
    for r in out:
        assert r.cluster_inertia == sum(d for _, c, d in want if c == r.cluster)
        text = ",".join(map(str, expected[r.cluster]))
        assert r.centroid_sha256 == hashlib.sha256(text.encode()).hexdigest()


def cloud(n, dims, groups, seed=0, noise=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims))
    x = (centres[rng.integers(0, groups, n)] + noise * rng.normal(size=(n, dims))).astype(np.float32)
    return [(int(i), [float(c) for c in v]) for i, v in enumerate(x)]


def test_groups(spark):
    check(spark, cloud(400, 6, 5), 6)


def test_no_groups(spark):
    check(spark, cloud(300, 9, 1, 1, 1.0), 9, block=7)


def test_rows_of_any_kind(spark):
    rows = cloud(30, 4, 3, 2)
    nan, inf = float("nan"), float("inf")
    rows += [(None, rows[0][1]), (None, rows[1][1]), (3, rows[0][1]), (50, None), (51, [nan] * 4), (52, [1.0, 2, 3, inf]),
             (53, [1.0, None, 0, 0]), (54, []), (55, [2.0] * 5), (56, [-0.0] * 4), (57, [0.0] * 4)]
    rows += [(60, rows[1][1])] * 50 + [(70 + k, rows[2][1]) for k in range(20)]
    check(spark, rows, 4)


@pytest.mark.parametrize("rows", [[(1, [1.0, 2.0])], [(k, [1.0, 1.0]) for k in range(12)], cloud(5, 2, 2)])
def test_few_vectors(spark, rows):
    check(spark, rows, 2)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0])]])
def test_nothing(spark, rows):
    found, places = C.cluster(table(spark, rows), "vec_id", "v", dims=2)
    assert found.collect() == [] and C.with_inertia(found, places).collect() == []


def test_too_large(spark):
    with pytest.raises(Exception, match="too large"):
        C.cluster(table(spark, [(1, [1e30, 0.0])]), "vec_id", "v", dims=2)


def test_curve_visits_every_cell_by_steps_to_neighbours():
    for dims, bits in ((2, 3), (3, 2), (4, 1)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij")).reshape(dims, -1)
        keys = [k.tobytes() for k in C.hilbert_keys(cells, bits)]
        assert len(set(keys)) == len(keys)
        path = cells[:, sorted(range(len(keys)), key=keys.__getitem__)]
        assert (np.abs(np.diff(path, axis=1)).sum(0) == 1).all()


def test_boxes_spare_comparisons(spark):
    """Blocks of vectors in groups mostly have one candidate, and one vector's block always has."""
    whole = C.whole_vectors(table(spark, cloud(2000, 8, 6)), "vec_id", "v", 8, 1024)
    blocks, n = C.blocks_of(whole, 8)
    batch = blocks.toArrow().combine_chunks().to_batches()[0]
    _, places = C.cluster(table(spark, cloud(2000, 8, 6)), "vec_id", "v", dims=8)
    settled = [x is None for _, x, *_ in C.nearest(batch, places)]
    assert n == 2000 and sum(settled) > len(settled) / 2

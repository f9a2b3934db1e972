import hashlib

import numpy as np
import pytest

from harvestframe.llm import simplexcluster as S

KIND = "vec_id bigint, embedding array<float>, label int, v string, apex string, cluster string, distance string, number string"


def vectors(n=300, seed=5, dims=64):
    rng = np.random.default_rng(seed)
    middle = rng.normal(0, 1, (12, dims))
    return [(i, (middle[i % 12] + rng.normal(0, 0.4, dims)).astype(np.float32).tolist()) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "v", "a", "c", "d", "n") for i, v in rows], KIND).repartition(5)


def brute(rows, k=40, rounds=5):
    whole = [(i, np.floor(256 * np.asarray(v, np.float64)).astype(np.int64)) for i, v in rows]
    order = sorted(whole, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1].tolist()))
    centers = [v.copy() for _, v in order[:k]]
    near = lambda v: min(((int(((v - c) ** 2).sum()), j) for j, c in enumerate(centers)))
    for _ in range(rounds):
        at = [near(v)[1] for _, v in whole]
        for j in range(len(centers)):
            mine = [v for (_, v), a in zip(whole, at) if a == j]
            if mine:
                centers[j] = np.array([int(s) // len(mine) for s in np.sum(mine, axis=0)])
    return [(i, near(v)[1], near(v)[0]) for i, v in whole], centers


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(1)
    middle = rng.integers(-300, 300, (8, 64))
    x = middle[rng.integers(0, 8, 500)] + rng.integers(-40, 40, (500, 64))
    simplex = S.Simplex(x[:40])
    assert 4 < len(simplex.pivots) <= S.PIVOTS
    a = simplex.apexes(simplex.distances2(x))
    low, high = simplex.bounds2(a, a[:50])
    exact = ((x[:, None] - x[None, :50]) ** 2).sum(axis=2)
    slack = S.SLACK * high.max()
    assert (low <= exact + slack).all() and (exact <= high + slack).all()
    assert np.allclose(a @ a.T * 0 + (a ** 2).sum(axis=1)[:, None], simplex.distances2(x)[:, :1])  # the first pivot is the origin
    best, far, compared = S.nearest(x, a, x[:40], simplex)
    assert (far == exact[:, :40].min(axis=1)).all() and (best == exact[:, :40].argmin(axis=1)).all()
    assert compared.mean() < 20


def test_degenerate_pivots_and_ties():
    same = np.ones((5, 64), np.int64)
    simplex = S.Simplex(same)
    assert len(simplex.pivots) == 1
    x = np.vstack([same, same * 3])
    best, far, _ = S.nearest(x, simplex.apexes(simplex.distances2(x)), np.vstack([same * 2, same * 2, same * 2]), simplex)
    assert best.tolist() == [0] * 10 and set(far.tolist()) == {64}


@pytest.mark.parametrize("n", [300, 23])
def test_clusters_equal_brute_force(spark, n):
    rows = vectors(n)
    rows += [rows[3], rows[3], (4, rows[5][1])]  # repeated rows, and one id with two vectors
    got, centers = S.clusters(frame(spark, rows))
    want, want_centers = brute(rows)
    assert sorted(tuple(r)[:3] for r in got.collect()) == sorted(want)
    assert centers.tolist() == [c.tolist() for c in want_centers]


def test_vectors_that_go(spark):
    good = vectors(30)
    bad = [(100, None), (101, []), (102, [1.0] * 63), (103, [1.0] * 65), (104, [None] + [1.0] * 63),
           (105, [float("nan")] * 64), (106, [1.0] * 63 + [float("inf")]), (None, [0.5] * 64)]
    got, _ = S.clusters(frame(spark, good + bad), k=4)
    assert sorted((r.vec_id is None, r.vec_id or 0) for r in got.collect()) == [(False, i) for i in range(30)] + [(True, 0)]
    assert S.clusters(frame(spark, bad[:7]))[0].count() == 0
    with pytest.raises(Exception, match="too large"):
        S.whole_vectors(frame(spark, [(1, [1e30] * 64)])).collect()


def test_string_ids(spark):
    rows = [(f"v{i}", v) for i, v in vectors(20)]
    got, _ = S.clusters(spark.createDataFrame(rows, "vec_id string, embedding array<double>"), k=3)
    assert sorted(r.vec_id for r in got.collect()) == sorted(r[0] for r in rows)

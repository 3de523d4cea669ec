"""VA-file clustering against brute force in whole numbers."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from alertfold.llm import va_cluster as V

SCHEMA = "vec_id long, embedding array<double>, label int, rid long, cluster string, cells string"


def usable(rows, dims):
    return [(i, v) for i, v in rows if v is not None and len(v) == dims
            and all(x is not None and math.isfinite(x) for x in v)]


def brute(rows, k, rounds, dims):
    rows = [(i, [math.floor(64 * x) for x in v]) for i, v in usable(rows, dims)]
    def digest(i):
        return "~" if i is None else hashlib.sha256(f"1:{i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(rows, key=lambda r: (digest(r[0]), r[1]))[:k]]

    def assigned():
        out = []
        for i, v in rows:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((i, v, d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        now = assigned()
        for c in range(len(centroids)):
            own = [v for _, v, at, _ in now if at == c]
            if own:
                centroids[c] = [sum(x) // len(own) for x in zip(*own)]
    now = assigned()
    total = sum(r[3] for r in now)
    return sorted((str(i), c, d, sum(r[3] for r in now if r[2] == c), total,
                   hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, _, c, d in now)


def vectors(n, dims, seed=1, scale=1.0):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, scale) for _ in range(dims)] for _ in range(6)]
    return [(i, [m + rng.gauss(0, scale / 2) for m in middles[i % 6]]) for i in range(n)]


def given(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "c", "x") for i, v in rows], SCHEMA)


@pytest.mark.parametrize("dims, k, scale", [(8, 5, 1.0), (7, 16, 0.05), (3, 4, 2000.0)])
def test_clusters_match_brute_force(spark, dims, k, scale):
    rows = vectors(220, dims, scale=scale)
    rows += [rows[3], rows[3], (3, rows[9][1]), (None, rows[1][1]), (None, [0.0] * dims), (500, None), (501, [1.0]),
             (502, [float("nan")] * dims), (503, [float("inf")] + [0.0] * (dims - 1)), (504, [None] + [0.0] * (dims - 1)),
             (505, [0.0] * dims), (506, [-0.0] * dims), (507, [0.25] * dims), (508, [0.25] * dims)]
    got = V.va_clusters(given(spark, rows), k=k, dims=dims).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == brute(rows, k, 3, dims)


def test_a_third_of_the_rows_equal_and_fewer_rows_than_centroids(spark):
    rows = vectors(60, 4) + [(100 + i, [0.5] * 4) for i in range(40)]
    got = V.va_clusters(given(spark, rows), k=6, dims=4).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == brute(rows, 6, 3, 4)
    few = rows[:3] + rows[-2:]
    got = V.va_clusters(given(spark, few), k=16, dims=4).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == brute(few, 16, 3, 4)


def test_empty_tables_and_components_too_large(spark):
    none = V.va_clusters(given(spark, []), dims=4)
    assert none.collect() == []
    assert none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert V.va_clusters(given(spark, [(1, None), (2, [1.0])]), dims=4).collect() == []
    with pytest.raises(ValueError):
        V.va_clusters(given(spark, [(1, [1e9] * 4)]), dims=4)


def test_intervals_hold_the_exact_distances_and_spare_most_rows():
    rng = np.random.default_rng(2)
    group = np.arange(800) % 5
    x = np.floor(rng.normal(0, 20, (800, 16)) + rng.normal(0, 100, (5, 16))[group]).astype(np.int64)
    inner = np.floor(np.quantile(x, np.arange(1, V.CELLS) / V.CELLS, axis=0).T).astype(np.int64)
    least = np.concatenate([x.min(0)[:, None], inner], 1)
    most = np.concatenate([inner - 1, x.max(0)[:, None]], 1)
    cells = V.cells_of(x, inner)
    assert (V.unpacked(pa.array([r.tobytes() for r in V.packed(cells)]), 16) == cells).all()
    centroids = np.stack([x[group == g].mean(0) for g in range(5)]).astype(np.int64)
    left = V.left_over(cells, V.lookup(least, most, centroids))
    exact = ((x[:, None] - centroids[None]) ** 2).sum(2)
    assert left[np.arange(800), exact.argmin(1)].all()
    at, d = V.nearest_left(x, left, centroids)
    assert (at == exact.argmin(1)).all() and (d == exact.min(1)).all()
    assert (left.sum(1) == 1).mean() > 0.9


@pytest.mark.parametrize("count", [1500, 400_000])
def test_fetching_does_not_shuffle_the_vectors(spark, count):
    rows = V.usable(given(spark, vectors(300, 4)), 4, "vec_id", "embedding")
    stored = V.stored(rows, count)
    wanted = stored.select("rid").filter("rid % 7 = 0").mapInArrow(lambda b: b, "rid long")
    plan = V.fetched(wanted, stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 1 and plan.count("Sort ") <= 1
    assert spark.conf.get(V.AQE) == "true"

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm.clustering import Clustering, SortedLists, cluster_vectors


def plain(points, centroids):
    far = ((points[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    return far.argmin(axis=1), far.min(axis=1)


@pytest.mark.parametrize("k, dims, spread", [(1, 3, 9), (8, 64, 600), (8, 2, 4), (40, 2, 2000), (25, 1, 12)])
def test_walk_finds_the_nearest_centroid(k, dims, spread):
    rng = np.random.default_rng(k)
    points, centroids = rng.integers(-spread, spread, (3000, dims)), rng.integers(-spread, spread, (k, dims))
    centroids[k // 2] = centroids[0]  # a tie for every point
    cluster, distance = SortedLists(centroids).nearest(points)
    expected = plain(points, centroids)
    assert (cluster == expected[0]).all() and (distance == expected[1]).all()


def test_most_centroids_are_never_measured():
    centroids = np.arange(200).reshape(-1, 1) * 1000
    lists = SortedLists(centroids)
    met = []
    lists.centroids = type("Seen", (np.ndarray,), {"__getitem__": lambda s, c: met.append(c) or np.ndarray.__getitem__(s, c)})(
        centroids.shape, centroids.dtype, centroids.copy()
    )
    cluster, _ = lists.nearest(np.array([[50_010], [50_020]]))
    assert cluster.tolist() == [50, 50] and len(set(met)) < 5


def brute(rows, how):
    kept = [(i, [int(np.floor(how.grid * np.float64(x))) for x in v]) for i, v in rows if v is not None and len(v) == how.dims and all(x is not None and np.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"{how.seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [p for _, p in sorted(kept, key=key)[: how.k]]
    def nearest(p):
        return min((sum((a - b) ** 2 for a, b in zip(p, c, strict=True)), n) for n, c in enumerate(centroids))
    for _ in range(how.rounds):
        placed = [nearest(p)[1] for _, p in kept]
        moved = []
        for n, c in enumerate(centroids):
            own = [p for (_, p), at in zip(kept, placed, strict=True) if at == n]
            moved.append([sum(x) // len(own) for x in zip(*own, strict=True)] if own else c)
        centroids = moved
    last = [nearest(p) for _, p in kept]
    inertia = Counter()
    for far, n in last:
        inertia[n] += far
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, n, far, inertia[n], sum(inertia.values()), sha[n]) for (i, _), (far, n) in zip(kept, last, strict=True))


def test_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    how = Clustering(k=6, dims=4, rounds=5, grid=64)
    rows = [(k, [float(x) for x in rng.normal(size=4)]) for k in range(150)]
    rows += [rows[0], rows[0], (None, rows[5][1]), (None, None), (200, []), (201, [1.0, 2.0, 3.0]), (202, [1.0, None, 0.0, 0.0])]
    rows += [(203, [float("nan"), 0.0, 0.0, 0.0]), (204, [0.0, float("inf"), 0.0, 0.0]), (205, [-1e-9, 0.0, -0.0, 2000.0])]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<double>, cluster string").repartition(4)
    assert Counter(map(tuple, cluster_vectors(df, how).collect())) == brute(rows, how)
    few = df.where("vec_id < 3")
    assert cluster_vectors(few, how).count() == 5
    assert cluster_vectors(df.where("vec_id = 200"), how).count() == 0 == cluster_vectors(df.where("false"), how).count()
    beyond = spark.createDataFrame([(1, [1e12, 0.0, 0.0, 0.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="grid steps"):
        cluster_vectors(beyond, how).count()

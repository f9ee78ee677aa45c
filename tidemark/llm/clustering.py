"""Centroid clustering of vectors in exact integer arithmetic, assigned by the threshold algorithm.

Every dimension keeps its centroid components as a sorted list.  A vector
enters each list at its own value and walks outward, nearest component first;
a centroid met in any list gets its exact distance.  A centroid not met yet
is, in every dimension, at least as far as that list's frontier, so its
distance is at least the sum of the squared frontier gaps: the walk ends when
that sum strictly exceeds the best exact distance.  All vectors of a batch
walk together, one numpy step for each depth.

Rounds sum up per task and then per cluster in Spark; the driver holds the
centroids and receives one row per cluster and round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.arrow import map_batches
from tidemark.operators.lineage import materialize

#: Grid components beyond this would not leave a squared distance within 64 bits.
LARGEST = 1 << 27
BLOCK = 4096


@dataclass(frozen=True)
class Clustering:
    """Clusters, dimensions, rounds, grid steps to the unit, seed of the first centroids."""

    k: int = 8
    dims: int = 64
    rounds: int = 10
    grid: int = 1024
    seed: int = 3


def grid_points(embeddings: DataFrame, how: Clustering, id_col: str, vector_col: str) -> DataFrame:
    """``(vec_id, point)``: vectors of the right size with finite components only, on the integer grid."""
    vector = F.col("vector")
    fits = (F.size(vector) == how.dims) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    rows = embeddings.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    point = F.transform(vector, lambda x: F.floor(x * F.lit(float(how.grid))))
    kept = rows.where(vector.isNotNull()).where(fits)
    kept = kept.withColumn("_out", F.exists(vector, lambda x: F.abs(x * F.lit(float(how.grid))) >= float(LARGEST)))
    beyond = F.raise_error(F.lit(f"a vector's component is beyond {LARGEST} grid steps: distances would not fit 64 bits"))
    return kept.select("vec_id", F.when(F.col("_out"), beyond.cast("array<bigint>")).otherwise(point).alias("point"))


def first_centroids(points: DataFrame, how: Clustering) -> np.ndarray:
    """The ``k`` points whose seeded id hash is least, in that order; ties by the point itself."""
    key = F.sha2(F.concat(F.lit(f"{how.seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = points.select(key.alias("h"), "point").orderBy("h", "point").limit(how.k).collect()
    return np.array([r["point"] for r in rows], np.int64).reshape(len(rows), how.dims)


class SortedLists:
    """The centroids, and for each dimension the order of their components."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable")
        self.values = np.take_along_axis(centroids, self.order, axis=0)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid (the smaller number in ties) and squared distance of each point."""
        k, dims = self.values.shape
        n = len(points)
        best = np.full(n, np.iinfo(np.int64).max)
        cluster = np.full(n, k, np.int64)
        met = np.zeros((n, k), bool)
        # frontier of each point and dimension: the next component above and below
        up = np.empty((n, dims), np.int64)
        for d in range(dims):
            up[:, d] = np.searchsorted(self.values[:, d], points[:, d])
        down = up - 1
        live = np.arange(n)
        column = np.arange(dims)
        for _ in range(k):
            x = points[live]
            above = np.where(up < k, self.values[np.minimum(up, k - 1), column] - x, LARGEST * 4)
            below = np.where(down >= 0, x - self.values[np.maximum(down, 0), column], LARGEST * 4)
            rises = above < below
            at = np.where(rises, up, down)
            gap = np.where(rises, above, below)
            found = np.zeros((len(live), k), bool)
            np.put_along_axis(found, self.order[at, column], True, axis=1)
            found &= ~met[live]
            met[live] |= found
            for c in range(k):
                who = np.flatnonzero(found[:, c])
                if not len(who):
                    continue
                far = x[who] - self.centroids[c]
                exact = np.einsum("ij,ij->i", far, far)
                rows = live[who]
                better = (exact < best[rows]) | ((exact == best[rows]) & (c < cluster[rows]))
                best[rows[better]], cluster[rows[better]] = exact[better], c
            up, down = up + rises, down - ~rises
            # the frontier after this step bounds every centroid not met; equal bounds may still hide a tie
            goes_on = (np.einsum("ij,ij->i", gap, gap) <= best[live]) & ~met[live].all(axis=1)
            live, up, down = live[goes_on], up[goes_on], down[goes_on]
            if not len(live):
                break
        return cluster, best


def _matrices(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            flat = pc.list_flatten(part.column("point")).to_numpy(zero_copy_only=False)
            yield part, flat.reshape(part.num_rows, dims)


def cluster_sums(points: DataFrame, centroids: np.ndarray, how: Clustering) -> dict[int, tuple[int, list[int]]]:
    """Members and component sums of every non-empty cluster, summed per task and then in Spark."""
    shared = points.sparkSession.sparkContext.broadcast(centroids)
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = SortedLists(shared.value)
        total, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for _, matrix in _matrices(batches, dims):
            cluster, _ = lists.nearest(matrix)
            total += np.bincount(cluster, minlength=k)
            for c in range(k):
                sums[c] += matrix[cluster == c].sum(axis=0)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(held, pa.int32()), pa.array(total[held]), pa.array(sums[held].tolist(), pa.list_(pa.int64()))],
            names=["cluster", "n", "sums"],
        )

    parts = map_batches(points.select("point"), run, "cluster int, n long, sums array<long>")
    summed = parts.groupBy("cluster").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[d]).alias(f"s{d}") for d in range(dims)])
    return {r["cluster"]: (r["n"], [r[f"s{d}"] for d in range(dims)]) for r in summed.collect()}


def fit_centroids(points: DataFrame, how: Clustering) -> np.ndarray:
    centroids = first_centroids(points, how)
    for _ in range(how.rounds if len(centroids) else 0):
        moved = centroids.copy()
        for c, (n, sums) in cluster_sums(points, centroids, how).items():
            moved[c] = [s // n for s in sums]
        if (moved == centroids).all():  # every later round would give the same
            break
        centroids = moved
    return centroids


def assign(points: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``(vec_id, cluster, distance)`` of every point."""
    shared = points.sparkSession.sparkContext.broadcast(centroids)
    dims = centroids.shape[1]
    kind = points.schema["vec_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = SortedLists(shared.value)
        for part, matrix in _matrices(batches, dims):
            cluster, distance = lists.nearest(matrix)
            yield pa.RecordBatch.from_arrays(
                [part.column("vec_id"), pa.array(cluster, pa.int32()), pa.array(distance)], names=["vec_id", "cluster", "distance"]
            )

    return map_batches(points, run, f"vec_id {kind}, cluster int, distance long")


def cluster_vectors(
    embeddings: DataFrame, how: Clustering = Clustering(), id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` per kept vector.

    Kept are vectors of exactly ``dims`` components, none NULL or non-finite,
    on the grid ``floor(grid * x)``.  With fewer than ``k`` of them there are
    as many centroids; with none, or an empty table, the result is empty.
    Repeated rows are vectors of their own; a NULL id hashes as an empty one
    and is kept.  A component beyond 2^27 grid steps is an error, since its
    distances would not fit.  Other columns are not read.
    """
    points = materialize(grid_points(embeddings, how, id_col, vector_col), "grid-points")
    centroids = fit_centroids(points, how)
    if not len(centroids):
        centroids = np.zeros((1, how.dims), np.int64)  # no point will be assigned
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    placed = materialize(assign(points, centroids), "assigned")
    sums = placed.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    inertia = {r["cluster"]: r["cluster_inertia"] for r in sums.collect()}
    each = F.array(*[F.lit(inertia.get(c, 0)).cast("long") for c in range(len(centroids))])
    return placed.select(
        "vec_id",
        "cluster",
        "distance",
        F.get(each, F.col("cluster")).alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        F.get(F.array(*[F.lit(h) for h in hashes]), F.col("cluster")).alias("centroid_sha256"),
    )

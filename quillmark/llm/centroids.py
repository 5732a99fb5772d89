"""Clustering of integer vectors around centroids, with the threshold algorithm as nearest-centroid search.

Each dimension has the centroids in a list sorted by their component. From a vector's component the lists are
walked outward; every centroid met is compared in full. The squared distances at which the lists stand add
up to a bound for all centroids not met yet, so a vector is done when that sum strictly exceeds the best
distance. Strictly, for an unmet centroid at the same distance could have the smaller number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.text import stored

SCALE = 64
LIMIT = 1 << 26  # components beyond would let a squared distance leave 64 bits
BLOCK = 2048  # vectors that walk the lists together
FAR = 1 << 62


def as_integers(vectors: DataFrame, dims: int, vec_id: str, vector: str) -> DataFrame:
    """``(vec_id, vec)`` of the vectors that take part, components scaled and rounded down."""
    vec = F.col(f"`{vector}`").cast("array<double>")
    usable = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) < LIMIT))
    rows = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), vec.alias("vec")).filter(F.size("vec") == dims)
    return rows.filter(usable).select("vec_id", F.transform("vec", lambda x: F.floor(x * SCALE)).alias("vec"))


class SortedLists:
    """Per dimension, the centroids ordered by component."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.order = np.argsort(centroids, axis=0, kind="stable")  # place in the list, dimension
        self.values = np.take_along_axis(centroids, self.order, 0)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid of each vector (ties: the smallest) and the squared distance."""
        parts = [self._walk(vectors[i : i + BLOCK]) for i in range(0, len(vectors), BLOCK)]
        none = np.zeros(0, np.int64)
        return tuple(np.concatenate([none, *column]) for column in zip(*parts)) if parts else (none, none)

    def _walk(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        count, dims = self.centroids.shape
        n, across = len(vectors), np.arange(dims)
        best, number = np.full(n, FAR), np.full(n, count)
        met = np.zeros((n, count), bool)
        above = np.stack([np.searchsorted(self.values[:, d], vectors[:, d]) for d in range(dims)], 1)
        below = above - 1
        going = np.arange(n)
        gap = lambda at, x: np.where((at >= 0) & (at < count), np.abs(self.values[np.clip(at, 0, count - 1), across] - x), LIMIT * 4)
        while len(going):
            x, up, down = vectors[going], above[going], below[going]
            gap_up, gap_down = gap(up, x), gap(down, x)
            upward = gap_up <= gap_down
            step = np.where(upward, up, down)
            here = np.zeros((len(going), count), bool)
            at = np.broadcast_to(np.arange(len(going))[:, None], step.shape)
            here[at, self.order[np.clip(step, 0, count - 1), across]] = True
            fresh, which = np.nonzero(here & ~met[going])
            distances = ((x[fresh] - self.centroids[which]) ** 2).sum(1)
            met[going] |= here
            order = np.lexsort((which, distances, fresh))
            first = order[np.concatenate(([True], fresh[order][1:] != fresh[order][:-1]))] if len(order) else order
            rows, d, c = going[fresh[first]], distances[first], which[first]
            better = (d < best[rows]) | ((d == best[rows]) & (c < number[rows]))
            best[rows[better]], number[rows[better]] = d[better], c[better]
            above[going], below[going] = up + upward, down - ~upward
            # What comes next in each list is the frontier of the centroids not met yet.
            frontier = np.minimum(gap(above[going], x), gap(below[going], x))
            bound = (frontier**2).sum(1)
            done = (bound > best[going]) | met[going].all(1)
            going = going[~done]
        return number, best


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def initial_centroids(rows: DataFrame, count: int) -> np.ndarray:
    """The vectors with the smallest hashes of their ids, ties by components; null ids come last."""
    order = F.sha2(F.concat(F.lit("1:"), F.col("vec_id").cast("string")), 256)
    first = rows.orderBy(order.asc_nulls_last(), "vec").limit(count).collect()  # ``count`` rows
    return np.array([r.vec for r in first], np.int64)


def moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids after one round: exact rounded-down means of their vectors; empty ones stay.

    Every task sums its own vectors per centroid; only those sums are shuffled, and as many numbers as the
    centroids have reach the driver.
    """
    shape = centroids.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, total, members = SortedLists(centroids), np.zeros(shape, np.int64), np.zeros(shape[0], np.int64)
        for batch in batches:
            vectors = _matrix(batch.column("vec"), shape[1])
            cluster, _ = lists.nearest(vectors)
            np.add.at(total, cluster, vectors)
            members += np.bincount(cluster, minlength=shape[0])
        used = np.flatnonzero(members)
        columns = [np.repeat(used, shape[1]), np.tile(np.arange(shape[1]), len(used)), total[used].ravel(), np.repeat(members[used], shape[1])]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["cluster", "dim", "total", "members"])

    parts = rows.select("vec").mapInArrow(sums, "cluster long, dim long, total long, members long")
    found = centroids.copy()
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    for r in parts.groupBy("cluster", "dim").agg(exact("total"), exact("members")).collect():
        found[r.cluster, r.dim] = int(r.total) // int(r.members)
    return found


def cluster(
    vectors: DataFrame, count: int = 16, rounds: int = 3, dims: int = 64, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Per vector: ``vec_id``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia``, ``centroid_sha256``.

    Vectors of exactly ``dims`` components take part, unless one is null, not finite, or of a size of ``2**20`` or
    more, which would leave 64 bits. A component becomes ``floor(64 * x)``. Centroids start as the ``count`` vectors with
    the smallest SHA-256 of ``1:<id>`` (all, if there are fewer); each round assigns vectors (ties: the smaller number)
    and moves every non-empty centroid to the rounded-down mean. Equal rows are vectors of their own, null ids are
    kept and start no centroid before any other. Other columns are ignored; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = stored(as_integers(vectors, dims, vec_id, vector), "integer-vectors")
    centroids = initial_centroids(rows, count)
    if not len(centroids):
        return spark.createDataFrame(
            [], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        )
    for _ in range(rounds):
        centroids = moved(rows, centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = SortedLists(centroids)
        for batch in batches:
            number, distance = lists.nearest(_matrix(batch.column("vec"), dims))
            columns = [batch.column("vec_id"), pa.array(number.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    placed = stored(rows.mapInArrow(assign, "vec_id long, cluster int, distance long"), "assigned")
    sums = placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("part")).collect()  # one row per cluster
    inertia = sum(int(r.part) for r in sums)
    known = [
        (r.cluster, int(r.part), inertia, hashlib.sha256(",".join(map(str, centroids[r.cluster].tolist())).encode()).hexdigest())
        for r in sums
    ]
    table = spark.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return placed.join(F.broadcast(table), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )

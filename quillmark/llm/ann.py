"""Nearest neighbours from balanced posting lists.

Centroids are fitted on a bounded sample. Every vector goes to the posting list of its nearest centroid
and, near a boundary, to those of other centroids that are almost as near. Lists over a size limit are
cut into parts that are searched side by side, and the queries of a list into blocks, so that no list is
one task's burden. Vectors find their lists on a
neighbour graph of the centroids, kept in memory, and so do queries, which read those whose centroid is not much
farther than the nearest: at most a share of all lists, so that recall does not fall as lists grow in number, and at
least as many as hold ``k`` other entries. Queries and lists meet in one join on the list's number.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.llm.text import stored

SAMPLE = 20_000  # vectors that centroids are fitted on
MAX_CENTROIDS = 4_096  # bounds the broadcast: 4,096 centroids of 64 floats are 1 MB
LIST_SIZE = 500  # vectors in one part of a posting list
QUERY_BLOCK = 2_000  # queries that search one part together


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """``(vec_id, vec)`` as doubles, without vectors that are null, empty, zero, or hold a null or non-finite part."""
    vec = F.col(vector).cast("array<double>")
    finite = F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists(vec, lambda x: x != 0)
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), vec.alias("vec"))
    return rows.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).filter(finite & some)


def fit_centroids(sample: np.ndarray, count: int, rounds: int = 12, seed: int = 11) -> np.ndarray:
    """Balanced k-means on a bounded sample: after each round, centroids of small clusters move into large ones."""
    rng = np.random.default_rng(seed)
    points = np.unique(sample, axis=0)
    count = min(count, len(points))
    centroids = points[rng.permutation(len(points))[:count]].copy()
    for step in range(rounds):
        nearest = _nearest(points, centroids)
        sizes = np.bincount(nearest, minlength=count)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, points)
        full = sizes > 0
        centroids[full] = sums[full] / sizes[full, None]
        if step < rounds - 2:
            large = np.argsort(-sizes)
            small = np.flatnonzero(sizes < len(points) / count / 8)
            for k, c in enumerate(small[: count // 4]):
                members = np.flatnonzero(nearest == large[k % max(1, count // 8)])
                centroids[c] = points[members[rng.integers(len(members))]]
    return centroids


def _nearest(points: np.ndarray, centroids: np.ndarray, block: int = 4096) -> np.ndarray:
    norms = (centroids**2).sum(1)
    parts = [np.argmin(norms - 2 * points[i : i + block] @ centroids.T, 1) for i in range(0, len(points), block)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int64)


class CentroidGraph:
    """Best-first search on the graph that joins each centroid to its nearest ones, both ways."""

    def __init__(self, centroids: np.ndarray, degree: int = 16):
        self.centroids = centroids
        n, degree = len(centroids), min(degree, len(centroids) - 1)
        norms = (centroids**2).sum(1)
        joined: list[set[int]] = [set() for _ in range(n)]
        for i in range(n):
            row = norms - 2 * centroids @ centroids[i]
            row[i] = -np.inf
            for j in np.argsort(row, kind="stable")[1 : degree + 1].tolist():
                joined[i].add(j)
                joined[j].add(i)
        self.edges = [np.array(sorted(s), np.int64) for s in joined]
        middle = ((centroids - centroids.mean(0)) ** 2).sum(1)
        spread = np.argsort(middle, kind="stable")
        self.entries = spread[:: max(1, n // 8)][:8]  # starts in every part, so that no island is missed

    def search(self, query: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroids found with a beam of ``width``, and their squared distances, nearest first."""
        seen = np.zeros(len(self.centroids), bool)
        first = ((self.centroids[self.entries] - query) ** 2).sum(1)
        seen[self.entries] = True
        todo = sorted(zip(first.tolist(), self.entries.tolist()))
        best = [(-d, c) for d, c in todo]
        heapq.heapify(best)
        while todo:
            d, c = heapq.heappop(todo)
            if len(best) >= width and d > -best[0][0]:
                break
            fresh = self.edges[c][~seen[self.edges[c]]]
            seen[fresh] = True
            near = ((self.centroids[fresh] - query) ** 2).sum(1) if len(fresh) else ()
            for e, x in zip(near, fresh.tolist()):
                if len(best) < width or e < -best[0][0]:
                    heapq.heappush(todo, (float(e), x))
                    heapq.heappush(best, (-float(e), x))
                    if len(best) > width:
                        heapq.heappop(best)
        found = sorted((-d, c) for d, c in best)
        return np.array([c for _, c in found]), np.array([d for d, _ in found])


def _lists_of(vec: Column, graph, width: int, ratio: float, most: int) -> Column:
    """Numbers of the lists whose centroid is at most ``1 + ratio`` times as far as the nearest."""

    @F.arrow_udf("array<int>")
    def lists(vectors: pa.Array) -> pa.Array:
        index, out = graph.value, []
        flat = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
        for query in flat:
            found, squared = index.search(query, width)
            near = squared <= (1 + ratio) ** 2 * squared[0] + 1e-12
            out.append(found[near][:most].tolist())
        return pa.array(out, pa.list_(pa.int32()))

    return lists(vec)


def _lists_to_read(vec: Column, shared, ratio: float, share: float, least: int, entries: int) -> Column:
    """Numbers of the lists that a query reads, nearest centroid first, found on the graph.

    Lists whose centroid is at most ``1 + ratio`` times as far as the nearest, cut to ``share`` of all lists or
    to ``least``, whichever is more; then further ones until they own ``entries`` entries. ``shared`` holds the
    graph and how many entries each list owns.
    """

    @F.arrow_udf("array<int>")
    def lists(vectors: pa.Array) -> pa.Array:
        graph, owned = shared.value
        count, out = len(graph.centroids), []
        most = max(least, math.ceil(share * count))
        flat = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)
        for query in flat:
            width = most
            order, squared = graph.search(query, width)
            while owned[order].sum() < entries and width < count:  # a wider beam, where near lists hold too few
                width *= 2
                order, squared = graph.search(query, width)
            if owned[order].sum() < entries:  # islands that the graph does not lead to
                order = np.concatenate((order, np.setdiff1d(np.arange(count), order)))
            near = np.searchsorted(squared, (1 + ratio) ** 2 * squared[0] + 1e-12, "right")
            enough = np.searchsorted(np.cumsum(owned[order]), entries) + 1
            out.append(order[: max(min(int(near), most), int(enough))].tolist())
        return pa.array(out, pa.list_(pa.int32()))

    return lists(vec)


def _squared(base: np.ndarray, queries: np.ndarray, few: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each query, rows of ``base`` that hold its ``few`` nearest, ties included, and their squared distances.

    A matrix product picks the rows with room for its rounding; their distances are then worked out directly.
    """
    norms = np.einsum("ij,ij->i", base, base)
    own = np.einsum("ij,ij->i", queries, queries)
    for at in range(0, len(queries), 256):
        some = queries[at : at + 256]
        rough = norms + own[at : at + 256, None] - 2 * some @ base.T
        room = 1e-12 * base.shape[1] * (norms.max() + own[at : at + 256])
        limits = np.partition(rough, few - 1, axis=1)[:, few - 1]
        for query, row, limit in zip(some, rough, limits + 2 * room):
            rows = np.flatnonzero(~(row > limit))
            squared = ((base[rows] - query) ** 2).sum(1)
            last = np.partition(squared, few - 1)[few - 1]
            yield rows[squared <= last], squared[squared <= last]


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    sample: int = SAMPLE,
    per_centroid: int = 200,
    replicate_ratio: float = 0.15,
    replicas: int = 4,
    search_ratio: float = 0.6,
    search_lists: int = 24,
    search_share: float = 0.3,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found for each row that ``is_query`` marks.

    ``is_query`` reads the column ``vec_id``. Nearness is the Euclidean distance in double precision on
    the original vectors, ties to the smaller id; a query's own row is no candidate. Vectors that are
    null, empty, zero or hold a null or non-finite part take no part, nor do those of another length than
    the smallest id's. Equal vectors are one entry with their ``k + 1`` smallest ids, which is all that any
    query can need of them. Rows with equal ids and vectors are one row. Queries have ``k`` neighbours wherever the
    table holds as many. An empty table gives an empty result.

    ``sample`` vectors (those of the smallest hashes) fit one centroid per ``per_centroid`` indexed vectors,
    ``MAX_CENTROIDS`` at most; all vectors are indexed. Lists within the ``search_ratio`` are read up to
    ``search_share`` of all, or ``search_lists`` if that is more: vectors without structure need a share.
    """
    spark = vectors.sparkSession
    result = "query_id long, rank int, vec_id long, score double"
    rows = usable(vectors, vec_id, vector)
    width = rows.orderBy("vec_id").select(F.size("vec")).first()
    if width is None:
        return spark.createDataFrame([], result)
    rows = rows.filter(F.size("vec") == width[0]).withColumn("key", F.md5(F.to_json(F.struct("vec"))))
    rows = stored(rows.dropDuplicates(["vec_id", "key"]), "vectors")
    least = F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))
    smallest = rows.select("key", "vec_id").withColumn("n", least).filter(F.col("n") <= k + 1)
    ids = smallest.groupBy("key").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    first = rows.join(ids.select("key", F.col("ids")[0].alias("vec_id"), "ids"), ["key", "vec_id"])
    entries = stored(first.select("key", "vec", "ids"), "entries")
    n_entries = entries.count()
    chosen = entries.orderBy("key").limit(sample).select("vec").collect()
    points = np.array([r.vec for r in chosen])
    centroids = fit_centroids(points, max(1, min(MAX_CENTROIDS, n_entries // per_centroid)))
    index = CentroidGraph(centroids)
    graph = spark.sparkContext.broadcast(index)

    own = _lists_of(F.col("vec"), graph, 16, replicate_ratio, replicas)
    posted = stored(entries.select("key", "vec", "ids", F.posexplode(own).alias("place", "list")), "postings")
    sizes = posted.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / LIST_SIZE).cast("int").alias("parts"))
    owned = np.zeros(len(centroids), np.int64)  # MAX_CENTROIDS at most
    for r in posted.filter("place = 0").groupBy("list").agg(F.count(F.lit(1)).alias("n")).collect():
        owned[r.list] = r.n
    posted = posted.drop("place")
    asked = rows.filter(is_query).select("key").distinct().join(entries.select("key", "vec"), "key")
    shared = spark.sparkContext.broadcast((index, owned))
    read = _lists_to_read(F.col("vec"), shared, search_ratio, search_share, search_lists, k + 1)
    visits = asked.select("key", "vec", F.explode(read).alias("list"))
    visits = stored(visits, "visits")
    blocks = visits.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("blocks"))
    cut = F.broadcast(sizes.join(blocks, "list"))  # one row per visited list, MAX_CENTROIDS at most
    hashed = lambda n: F.pmod(F.xxhash64("key"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    lists = posted.join(cut, "list").withColumn("part", hashed("parts")).withColumn("block", every("blocks"))
    visits = visits.join(cut, "list").withColumn("block", hashed("blocks")).withColumn("part", every("parts"))
    lists, visits = lists.drop("parts", "blocks"), visits.drop("parts", "blocks")

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        found = ([], [], [])
        if len(left) and len(right):
            base = right.column("vec").combine_chunks().flatten().to_numpy().reshape(len(right), -1)
            names = right.column("ids").combine_chunks()
            keys = left.column("key").to_pylist()
            queries = left.column("vec").combine_chunks().flatten().to_numpy().reshape(len(left), -1)
            for key, (near, squared) in zip(keys, _squared(base, queries, min(k + 1, len(base)))):
                for i, d in zip(near.tolist(), np.sqrt(squared).tolist()):
                    found[0].append(key)
                    found[1].append(names[i].as_py())
                    found[2].append(d)
        types = (pa.string(), pa.list_(pa.int64()), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(found, types)], names=["key", "ids", "score"])

    near = visits.groupBy("list", "part", "block").cogroup(lists.groupBy("list", "part", "block"))
    hits = near.applyInArrow(search, "key string, ids array<long>, score double")
    hits = hits.select("key", "score", F.explode("ids").alias("vec_id")).distinct()
    order = Window.partitionBy("key").orderBy("score", "vec_id")
    best = stored(hits.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1).drop("n"), "nearest")
    queries = rows.filter(is_query).select("key", F.col("vec_id").alias("query_id"))
    answers = stored(queries, "queries").join(best, "key").filter("vec_id <> query_id")
    ranked = answers.withColumn("rank", F.row_number().over(Window.partitionBy("query_id", "key").orderBy("score", "vec_id")))
    return ranked.filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

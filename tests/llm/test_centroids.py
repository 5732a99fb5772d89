"""Clusters against brute force, with ties, repeats and vectors that take no part."""

import hashlib
import math

import numpy as np
import pytest

from quillmark.llm import centroids
from quillmark.llm.centroids import SortedLists


def brute(vectors, lists):
    distances = ((vectors[:, None, :].astype(object) - lists[None].astype(object)) ** 2).sum(2).astype(np.int64)
    return distances.argmin(1), distances.min(1)


@pytest.mark.parametrize("spread", [1, 3, 60, 1 << 25])
@pytest.mark.parametrize("count", [1, 2, 16])
def test_threshold_search_equals_brute_force(spread, count):
    rng = np.random.default_rng(spread + count)
    lists = rng.integers(-spread, spread + 1, (count, 8))
    lists[-1] = lists[0]  # two centroids in one place: the smaller number wins
    vectors = np.concatenate([rng.integers(-spread, spread + 1, (500, 8)), lists, (lists[:1] + lists) // 2])
    number, distance = SortedLists(lists).nearest(vectors)
    wanted = brute(vectors, lists)
    assert (number == wanted[0]).all() and (distance == wanted[1]).all()


def test_walk_stops_before_all_centroids_are_met():
    """Far centroids are not compared: their lists are left before they come up."""
    lists = np.arange(16)[:, None] * np.full((1, 4), 1000)
    walked = SortedLists(lists)
    seen = []
    real = walked.centroids
    walked.centroids = Watched(real, seen)
    walked._walk(np.full((1, 4), 3))
    assert 0 < len(set(seen)) < 4


class Watched(np.ndarray):
    def __new__(cls, array, seen):
        out = np.asarray(array).view(cls)
        out.seen = seen
        return out

    def __getitem__(self, at):
        if isinstance(at, np.ndarray):
            self.seen += at.tolist()
        return np.asarray(super().__getitem__(at))


def plain(rows, count=16, rounds=3, dims=64):
    kept = [
        (i, [math.floor(64 * float(x)) for x in v])
        for i, v in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(64 * x) < 1 << 26 for x in v)
    ]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    first = sorted(kept, key=lambda r: (r[0] is None, sha(f"1:{r[0]}"), r[1]))[:count]
    if not first:
        return []
    lists, vectors = np.array([v for _, v in first]), np.array([v for _, v in kept])
    for _ in range(rounds):
        number, _ = brute(vectors, lists)
        for c in range(len(lists)):
            mine = vectors[number == c]
            if len(mine):
                lists[c] = [sum(int(x) for x in column) // len(mine) for column in mine.T]
    number, distance = brute(vectors, lists)
    parts = [int(distance[number == c].sum()) for c in range(len(lists))]
    digests = [sha(",".join(map(str, c.tolist()))) for c in lists]
    return [(i, int(c), int(d), parts[c], sum(parts), digests[c]) for (i, _), c, d in zip(kept, number, distance)]


def test_equals_plain_lloyd(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(0, 1 + i % 3, 64).astype("f4").tolist()) for i in range(400)]
    rows += [(400 + i, rows[0][1]) for i in range(150)]  # copies
    rows += [(5, rows[7][1]), (None, rows[3][1]), (None, rows[3][1])]
    rows += [(900, None), (901, []), (902, [1.0] * 63), (903, [None] + [0.0] * 63), (904, [float("nan")] * 64), (905, [float("inf")] + [0.0] * 63)]
    rows += [(906, [0.0] * 64), (907, [3e9] + [0.0] * 63), (908, [-0.001] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    df = df.selectExpr("*", "'mine' AS cluster", "'mine' AS vec", "1 AS distance")
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    found = sorted((tuple(r) for r in centroids.cluster(df).collect()), key=key)
    assert found == sorted(plain(rows), key=key)


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(1, [1.0] * 64), (2, [1.0] * 64)], "vec_id long, embedding array<float>")
    rows = centroids.cluster(df).collect()
    assert {r["cluster"] for r in rows} == {0} and rows[0]["inertia"] == 0
    assert centroids.cluster(df.limit(0)).count() == 0
    assert centroids.cluster(df.filter("vec_id = 9")).columns == rows[0].__fields__

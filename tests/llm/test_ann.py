"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmark.llm import ann as q


def _table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.selectExpr("*", "'mine' AS rank", "'mine' AS key", "'mine' AS list").repartition(3)


def _exact(ids, vectors, k=10):
    found = {}
    for i in np.flatnonzero(ids % 100 == 0):
        d = np.sqrt(((vectors - vectors[i]) ** 2).sum(1))
        order = [j for j in np.lexsort((ids, d)) if j != i][:k]
        found[ids[i]] = [(ids[j], d[j]) for j in order]
    return found


def _answers(df):
    got = {}
    for r in df.collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {i: sorted(x) for i, x in got.items()}


def test_recall_order_and_scores(spark):
    rng = np.random.default_rng(2)
    centers = rng.normal(size=(30, 16))
    vectors = (centers[rng.integers(0, 30, 6000)] + 0.5 * rng.normal(size=(6000, 16))).astype(np.float32).astype(float)
    ids = np.arange(6000)
    got = _answers(q.nearest_neighbours(_table(spark, list(zip(ids.tolist(), vectors.tolist()))), F.col("vec_id") % 100 == 0))
    exact = _exact(ids, vectors)
    assert set(got) == set(exact)
    hits = 0
    for i, rows in got.items():
        assert [r[0] for r in rows] == list(range(1, 11))
        assert [(r[2], r[1]) for r in rows] == sorted((r[2], r[1]) for r in rows)
        for _, j, score in rows:
            assert score == pytest.approx(float(np.sqrt(((vectors[i] - vectors[j]) ** 2).sum())), abs=1e-12)
        hits += len({r[1] for r in rows} & {j for j, _ in exact[i]})
    assert hits / (10 * len(exact)) >= 0.95


def test_copies_ties_and_bad_vectors(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(300)]
    rows += [(300, None), (400, [0.0, 0.0, 0.0]), (500, [1.0, None, 2.0]), (600, [float("nan"), 1.0, 1.0])]
    rows += [(700, [float("inf"), 1.0, 1.0]), (800, []), (900, [1.0]), (None, same), (1000, [1.0, 2.0, 4.0]), (0, same)]
    got = _answers(q.nearest_neighbours(_table(spark, rows), F.col("vec_id") % 100 == 0))
    assert set(got) == {0, 100, 200, 1000}
    assert [r[1] for r in got[0]] == list(range(1, 11)) and {r[2] for r in got[0]} == {0.0}
    assert [r[1] for r in got[100]] == list(range(10))
    assert [(r[1], r[2]) for r in got[1000]] == [(i, 1.0) for i in range(10)]


def test_few_or_no_vectors(spark):
    few = _answers(q.nearest_neighbours(_table(spark, [(0, [1.0, 0.0]), (5, [0.0, 1.0])]), F.col("vec_id") % 100 == 0))
    assert [(r[0], r[1]) for r in few[0]] == [(1, 5)]
    assert q.nearest_neighbours(_table(spark, [(0, [1.0])]), F.col("vec_id") % 100 == 0).collect() == []
    assert q.nearest_neighbours(_table(spark, [(0, None)]), F.col("vec_id") % 100 == 0).collect() == []


def test_large_lists_are_cut(spark, monkeypatch):
    monkeypatch.setattr(q, "LIST_SIZE", 7)
    monkeypatch.setattr(q, "QUERY_BLOCK", 2)
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(1000, 4)).astype(np.float32).astype(float)
    ids = np.arange(1000)
    got = _answers(q.nearest_neighbours(_table(spark, list(zip(ids.tolist(), vectors.tolist()))), F.col("vec_id") % 100 == 0))
    exact = _exact(ids, vectors)
    assert sum(len({r[1] for r in got[i]} & {j for j, _ in exact[i]}) for i in exact) >= 0.95 * 10 * len(exact)


def test_graph_search_finds_the_nearest_centroids():
    rng = np.random.default_rng(6)
    centroids = rng.normal(size=(400, 8))
    graph = q.CentroidGraph(centroids)
    hits = 0
    for query in rng.normal(size=(100, 8)):
        exact = np.argsort(((centroids - query) ** 2).sum(1))[:10]
        hits += len(set(graph.search(query, 48)[0][:10].tolist()) & set(exact.tolist()))
    assert hits >= 980


def test_recall_where_lists_are_many(spark):
    """Unit vectors without structure, like the given ones, in 300 lists; 24 of them are under a tenth."""
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(6000, 64))
    vectors = (vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.float32).astype(float)
    ids = np.arange(6000)
    table = _table(spark, list(zip(ids.tolist(), vectors.tolist())))
    got = _answers(q.nearest_neighbours(table, F.col("vec_id") % 100 == 0, per_centroid=20))
    exact = _exact(ids, vectors)
    assert sum(len({r[1] for r in got[i]} & {j for j, _ in exact[i]}) for i in exact) >= 0.97 * 10 * len(exact)


def test_queries_whose_near_lists_hold_too_few_read_on(spark):
    rng = np.random.default_rng(9)
    vectors = (np.repeat(1000 * rng.normal(size=(200, 8)), 3, axis=0) + rng.normal(size=(600, 8))).astype(np.float32).astype(float)
    ids = np.arange(600)
    table = _table(spark, list(zip(ids.tolist(), vectors.tolist())))
    got = _answers(q.nearest_neighbours(table, F.col("vec_id") % 100 == 0, per_centroid=3))
    assert {i: len(rows) for i, rows in got.items()} == dict.fromkeys(range(0, 600, 100), 10)

"""Mixing: targets, repeats and edges; whole tables are compared with SQL."""

import llm_cases as cases

from quillmark.llm import mixing as q


def test_rows_and_targets(spark):
    got = q.mix(cases.documents(spark)).collect()
    assert len(got) == len(cases.ROWS)
    total = sum(len(cases.words(r[1])) for r in cases.ROWS)
    sizes, targets, taken = {}, {}, {}
    for r in got:
        assert r["size"] == len(cases.words(r["text"])) and r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        sizes[r["source"]], targets[r["source"]] = r["source_size"], r["target"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        assert r["score"] == "mine" and r["lang"] in ("en", "fr", None)
    assert abs(sum(targets.values()) - total) < 1e-6
    assert all(targets[s] <= 3 * sizes[s] for s in sizes) and targets["b"] == 0
    largest = max(r["size"] for r in got)
    assert all(abs(taken[s] - targets[s]) <= largest for s in sizes)
    again = q.mix(cases.documents(spark).repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_close_to_targets_and_budgets_nest(spark):
    rows = [(i, "w " * (1 + i % 7), "en", "ab"[i % 2], 0) for i in range(4000)]
    docs = cases.documents(spark, rows)
    some = {r["doc_id"]: r["copies"] for r in q.mix(docs, weights=(1, 2)).collect()}
    more = {r["doc_id"]: r["copies"] for r in q.mix(docs, weights=(1, 4)).collect()}
    assert all(more[i] >= n for i, n in some.items() if i % 2)
    assert all(more[i] <= n for i, n in some.items() if not i % 2)
    for r in q.mix(docs, weights=(1, 2)).groupBy("source").agg({"taken": "sum", "target": "max"}).collect():
        assert abs(r["sum(taken)"] - r["max(target)"]) <= 7


def test_empty_and_blank_tables(spark):
    assert q.mix(cases.empty(spark)).collect() == []
    blank = q.mix(cases.documents(spark, [(1, "", "en", "a", 0), (2, None, "en", None, 0)])).collect()
    assert [(r["size"], r["target"], r["taken"]) for r in blank] == [(0, 0.0, 0)] * 2

"""Rule ensemble: statistics, compiled rules, held-out accuracy, edges."""

import math

import llm_cases as cases
from pyspark.sql import functions as F

from quillmark.llm import rule_ensemble as q

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    judged = q.classify(docs.select("doc_id", "text"), labels).filter("held_out").join(labels, "doc_id")
    by = {r["quality"]: (r["n"], r["p"]) for r in judged.groupBy("quality").agg(F.count("*").alias("n"), F.avg("predicted").alias("p")).collect()}
    assert by[1][0] > 40 and by[1][1] > 0.97 and by[0][1] < 0.3


def test_compiled_score_equals_plain_evaluation(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = q.stored(q.training_rows(docs, labels, "doc_id", "text", "quality", 5, 150), "t")
    assert rows.count() == 150
    ensemble = q.fit_rules(rows)
    assert 1 <= len(ensemble.rules) <= 168 and q.fit_rules(rows) == ensemble
    for r in q.with_statistics(docs, "text").withColumn("s", ensemble.score()).select("_stats", "s").limit(300).collect():
        holds = lambda rule: all(r["_stats"][s] <= v if op == "<=" else r["_stats"][s] > v for s, op, v in rule.terms)
        margin = ensemble.intercept + sum(w for rule, w in ensemble.rules if holds(rule))
        assert math.isclose(r["s"], 1 / (1 + math.exp(-margin)), rel_tol=1e-9)


def test_scoring_is_one_map(spark, sf_dir):
    import __spark_entry__ as entry

    text = entry.queries()["op10_rule_ensemble"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Exchange" not in text and "Join" not in text


def test_edges(spark):
    docs, labels = cases.documents(spark), cases.labels(spark)
    got = q.classify(docs, labels).collect()
    assert len(got) == len(cases.ROWS)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) and r["kept"] == "mine" for r in got)
    assert {r["held_out"] for r in got if r["doc_id"] is None} == {True}
    nothing = {r["score"] for r in got if r["text"] in (None, "")}
    assert len(nothing) == 1
    assert {r["score"] for r in q.classify(docs, labels.limit(0)).collect()} == {0.5}
    ones = {r["score"] for r in q.classify(docs, labels.filter("quality = 1")).collect()}
    assert len(ones) == 1 and ones.pop() > 0.5
    assert q.classify(cases.empty(spark), labels).collect() == []


def test_statistics_of_a_small_text(spark):
    row = q.with_statistics(spark.createDataFrame([("Ab ab ab 12!\n|#\nAb ab ab 12!",)], "text string")).first()["_stats"]
    assert math.isclose(row["log_words"], math.log(10)) and row["distinct_words"] == 4 / 9
    assert row["repeated_neighbours"] == 2 / 8 * 8 / 9 + 0 or row["repeated_neighbours"] == 2 / 9
    assert row["repeated_lines"] == 1 / 3 and row["line_words"] == 3 and row["bars"] == 1 / 28

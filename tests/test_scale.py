"""Skewed inputs against plain Python: hot groups, heavy ties, more rows than Spark's own limits."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillmark.operators import corpus, evaluation
from quillmark.operators.dedup import dedup_exact, dedup_report
from quillmark.operators.ranking import quantiles_by_group, top_n
from quillmark.operators.summaries import ttr_histogram


def test_dedup_with_one_text_in_a_third_of_the_rows(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"text {i % 500}") for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, text string").repartition(7)
    kept = {r["text"]: r["id"] for r in dedup_exact(df, "text", ["id"]).collect()}
    first = {}
    for i, text in rows:
        first.setdefault(text, i)
    assert kept == first
    report = dedup_report(df).first()
    assert tuple(report) == (3000, len(first), 3000 - len(first))


def test_dedup_survivor_does_not_depend_on_partitions(spark):
    rows = [(f"text {i % 40}", "s", "c", i) for i in range(800)]
    df = spark.createDataFrame(rows, "text string, subset string, category string, id int")
    survivors = [
        {tuple(r) for r in dedup_exact(df.repartition(n), "text", ["subset", "category"]).collect()} for n in (1, 3, 7)
    ]
    assert survivors[0] == survivors[1] == survivors[2] == {(f"text {i}", "s", "c", i) for i in range(40)}


@pytest.mark.parametrize("n", [5, 1000, 1500])
def test_top_n_beyond_sparks_own_limit(spark, n):
    rnd = random.Random(1)
    rows = [("hot" if i % 3 else f"g{i % 5}", f"t{i}", rnd.randint(0, 50)) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, term string, n int").repartition(6)
    got = top_n(df, ["g"], [F.desc("n"), F.asc("term")], n, "term")
    got = {(r["g"], r["rank"]): r["term"] for r in got.collect()}
    expected = {}
    for g in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[2], r[1]))
        expected.update({(g, i + 1): r[1] for i, r in enumerate(group[:n])})
    assert got == expected


def quantile(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    low = int(at)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (at - low)


def test_quantiles_with_heavy_ties(spark):
    rnd = random.Random(2)
    rows = [(int(i % 9 == 0), 1.0 if i % 3 else rnd.gauss(0, 1), rnd.randint(0, 3)) for i in range(4000)]
    df = spark.createDataFrame(rows, "c int, a double, b int").repartition(5)
    got = {(r["c"], r["feature"], r["prob"]): r["value"] for r in quantiles_by_group(df, "c", ["a", "b"], slices=7).collect()}
    for c in (0, 1):
        for j, name in ((1, "a"), (2, "b")):
            values = [float(r[j]) for r in rows if r[0] == c]
            for p in (0.25, 0.5, 0.75):
                assert got[c, name, p] == pytest.approx(quantile(values, p))


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("slices", [1, 2, 16])
def test_roc_with_a_third_of_the_rows_on_one_score(spark, slices):
    rnd = random.Random(3)
    rows = [(int(rnd.random() < 0.2), 0.5 if i % 3 == 0 else round(rnd.random() ** 3, 2)) for i in range(1500)]
    df = spark.createDataFrame(rows, "category_encode int, score double").repartition(4)
    assert evaluation.roc_auc(df, slices=slices).first()["roc_auc"] == pytest.approx(brute_auc(rows))
    points = {r["threshold"]: (r["fpr"], r["tpr"]) for r in evaluation.roc_curve(df, slices=slices).collect()}
    assert set(points) == {s for _, s in rows}
    for t in (0.5, min(points), max(points)):
        for side, y in ((0, 0), (1, 1)):
            ofclass = [s for label, s in rows if label == y]
            assert points[t][side] == pytest.approx(sum(s >= t for s in ofclass) / len(ofclass))


def test_roc_agrees_with_the_evaluator(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    rnd = random.Random(4)
    rows = [(int(rnd.random() < 0.4), rnd.random()) for _ in range(500)]
    df = spark.createDataFrame(rows, "category_encode int, score double")
    evaluator = BinaryClassificationEvaluator(labelCol="category_encode", rawPredictionCol="score", numBins=0)
    assert evaluation.roc_auc(df).first()["roc_auc"] == pytest.approx(evaluator.evaluate(df))


def test_class_metrics_agree_with_the_evaluator(spark):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    rnd = random.Random(5)
    rows = [(int(rnd.random() < 0.3), float(rnd.random() < 0.4)) for _ in range(700)]
    df = spark.createDataFrame(rows, "category_encode int, prediction double")
    means = evaluation.weighted_metrics(evaluation.confusion_matrix(df)).first()
    for ours, theirs in (("accuracy", "accuracy"), ("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1", "f1")):
        judge = MulticlassClassificationEvaluator(labelCol="category_encode", predictionCol="prediction", metricName=theirs)
        assert means[ours] == pytest.approx(judge.evaluate(df))


def test_histogram_counts_every_row(spark):
    rows = [(0, float(i % 17)) for i in range(400)] + [(1, 0.5)] * 30
    df = spark.createDataFrame(rows, "category_encode int, doc_ttr double")
    bins = ttr_histogram(df, bins=4).collect()
    assert Counter({(r["category_encode"], r["bin"]): r["n"] for r in bins}) == Counter(
        (c, min(int(v / 16 * 4), 3) if c == 0 else 2) for c, v in rows
    )


def test_corpus_identities(spark, sf_dir):
    """Tokens of both classes add up; a document with k tokens gives k - 1 bigrams."""
    from checks import tables

    docs = tables.processed(spark, sf_dir).filter("category_encode IS NOT NULL AND length(processed_text) > 0")
    terms = corpus.explode_terms(docs, keep=("category_encode",))
    stats = {r["class"]: r for r in corpus.lexical_stats(corpus.term_counts_by_class(terms)).collect()}
    assert stats["HUMAN"]["total_tokens"] + stats["AI"]["total_tokens"] == stats["ALL"]["total_tokens"]
    with_words = docs.filter(F.size(F.regexp_extract_all("processed_text", F.lit("[؀-ۿ]{2,}"), F.lit(0))) > 0).count()
    assert stats["ALL"]["total_tokens"] - stats["ALL"]["total_bigrams"] == with_words

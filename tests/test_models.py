"""Feature stages, training, saving."""

import math
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from quillmark.functions.stylometry import STYLO_COLUMNS
from quillmark.operators import features, models
from quillmark.plans.preparation import add_style, load_long, preprocess
from quillmark.plans.training import build_features, evaluation_report, save_all, save_best, train_all
from quillmark.profiles import LATIN
from quillmark.sources import artifacts, files
from quillmark.sources.scratch import scratch_dir


@pytest.fixture(scope="module")
def corpus(spark):
    """Two classes that differ in their words."""
    rnd = random.Random(9)
    words = {1: ["river", "stone", "light", "field", "cloud", "moss"], 0: ["model", "result", "method", "paper", "field", "cloud"]}
    rows = [(i, int(i % 4 == 0), " ".join(rnd.choices(words[int(i % 4 == 0)], k=rnd.randint(5, 25))) + ".") for i in range(240)]
    return add_style(spark.createDataFrame(rows, "id int, category_encode int, text string"), LATIN)


@pytest.fixture(scope="module")
def tables(spark, corpus):
    return build_features(corpus, scratch_dir(spark, "features"), "id", num_features=200)


def test_tfidf_weights(spark):
    docs = [["a", "a", "b"], ["a", "c"], ["b", "d"]]
    df = spark.createDataFrame([(" ".join(d),) for d in docs], "processed_text string")
    *front, idf = features.tfidf_stages(num_features=4096)
    for stage in front:
        df = stage.transform(df)
    got = idf.fit(df).transform(df).select("tokens", vector_to_array("tfidf_features").alias("w")).collect()
    seen = {t: sum(t in d for d in docs) for t in "abcd"}
    for row, doc in zip(got, docs):
        expected = sorted(doc.count(t) * math.log(4 / (seen[t] + 1)) for t in set(doc) if seen[t] >= 2)
        assert sorted(x for x in row["w"] if x) == pytest.approx(expected)


def test_ngram_option(spark):
    df = spark.createDataFrame([("a b c",), ("a b d",)], "processed_text string")
    stages = features.tfidf_stages(num_features=64, ngram=2)
    for stage in stages[:-1]:
        df = stage.transform(df)
    assert df.first()["ngrams"] == ["a b", "b c"]


def test_feature_tables(tables):
    train, test = tables.split("train"), tables.split("test")
    row = train.select(F.size(vector_to_array("features")).alias("n"), F.size(vector_to_array("features_stylo")).alias("s")).first()
    assert (row["n"], row["s"]) == (len(STYLO_COLUMNS) + 200, len(STYLO_COLUMNS))
    assert train.count() + test.count() + tables.split("val").count() == 240


def test_rows_with_gaps_are_skipped(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (float("nan"), 2.0)], "a double, b double")
    first, _ = features.assemblers(("a", "b"))
    assert first.transform(df).count() == 1


def test_defaults():
    lr, rf, gbt = (make() for make in models.CLASSIFIERS.values())
    assert (lr.getMaxIter(), lr.getRegParam(), lr.getElasticNetParam()) == (50, 0.01, 0.0)
    assert (rf.getNumTrees(), rf.getMaxDepth(), rf.getSeed()) == (100, 10, 42)
    assert (gbt.getMaxIter(), gbt.getMaxDepth(), gbt.getStepSize(), gbt.getSeed()) == (50, 6, 0.1, 42)


def test_train_choose_save_load(spark, corpus, tables):
    small = {"RandomForest": {"numTrees": 5, "maxDepth": 3}, "GBTClassifier": {"maxIter": 3, "maxDepth": 2}}
    fitted, metrics = train_all(tables, params=small)
    rows = {(r["model"], r["split"], r["metric"]): r["value"] for r in metrics.collect()}
    assert {m for m, _, _ in rows} == set(models.CLASSIFIERS)
    assert rows["LogisticRegression", "test", "accuracy"] > 0.9
    assert rows["LogisticRegression", "train", "train_time_s"] > 0
    confusion = evaluation_report(tables)["confusion"].filter("split = 'test'").groupBy("model").sum("n").collect()
    assert {r["sum(n)"] for r in confusion} == {tables.split("test").count()}
    path = scratch_dir(spark, "model")
    best = save_best(tables, fitted, metrics, path)
    everything = scratch_dir(spark, "models")
    assert save_all(tables, fitted, metrics, everything) == best
    assert all(artifacts.load_model(f"{everything}/{name}").stages for name in (*models.CLASSIFIERS, "best"))
    assert spark.read.json(f"{everything}/report/best").first()["model"] == best
    assert rows[best, "val", "f1"] == max(rows[m, "val", "f1"] for m in models.CLASSIFIERS)
    pipeline = artifacts.load_model(path)
    scored = models.score(pipeline, corpus).select("id", "prediction", "score")
    direct = models.score(models.scoring_pipeline(tables.model, fitted[best]), corpus).select("id", "prediction", "score")
    assert scored.exceptAll(direct).count() == 0 and scored.count() == 240


def test_stylo_baseline_pipeline(corpus, tables):
    model, _ = models.train("LogisticRegression", tables.split("train"), models.STYLO_FEATURES)
    assert model.numFeatures == len(STYLO_COLUMNS)
    assert models.scoring_pipeline(tables.model, model).transform(corpus).count() == 240


def test_class_weights(spark, tables):
    weighted = tables.split("train").withColumn("w", F.when(F.col("category_encode") == 1, 3.0).otherwise(1.0))
    model, _ = models.train("LogisticRegression", weighted, weightCol="w")
    assert model.transform(tables.split("test")).count() > 0


def test_raw_tables_to_corpus(spark, tmp_path):
    """Wide subsets to a written corpus, read back."""
    wide = "original_abstract string, model_generated_abstract string, title string"
    rows = {"by_polishing": [("نص بشري اول", "نص مولد اول", "t"), ("نص بشري ثان", None, "t")],
            "from_title": [("نص بشري اول", "نص مولد ثالث", "t"), ("123", "نص مولد اول", "t")]}
    for name, values in rows.items():
        spark.createDataFrame(values, wide).write.parquet(str(tmp_path / f"{name}.parquet"))
    subsets = tuple(rows)
    raw = load_long(spark, str(tmp_path), subsets)
    assert raw.columns == ["category", "text", "subset", "category_encode"] and raw.count() == 8
    done = preprocess(raw, subsets=subsets)
    out = str(tmp_path / "out")
    assert files.write_corpus(done, out, partition_by=("subset",)) == 4
    got = {(r["text"], r["subset"], r["category_encode"]) for r in files.read_corpus(spark, out).collect()}
    assert got == {("نص بشري اول", "by_polishing", 1), ("نص مولد اول", "by_polishing", 0),
                   ("نص بشري ثان", "by_polishing", 1), ("نص مولد ثالث", "from_title", 0)}


@pytest.mark.parametrize("name, parts", [("RandomForest", 3), ("GBTClassifier", 3), ("LogisticRegression", 1)])
def test_a_task_of_a_tree_learner_holds_a_bounded_number_of_rows(spark, monkeypatch, name, parts):
    seen = []

    class Learner:
        def fit(self, df):
            seen.append((df.count(), df.rdd.getNumPartitions()))

    monkeypatch.setitem(models.CLASSIFIERS, name, lambda features, **params: Learner())
    models.train(name, spark.range(2 * models.ROWS_PER_TASK + 1).coalesce(1))
    models.train(name, spark.range(10).coalesce(1))
    assert seen == [(2 * models.ROWS_PER_TASK + 1, parts), (10, 1)]


def test_uneven_partitions_are_dealt_even_where_there_are_enough(spark):
    """Nine thousand rows in one of eight partitions."""
    from quillmark.operators.models import dealt

    uneven = spark.range(10_000).repartition(8, F.when(F.col("id") < 9_000, 0).otherwise(F.col("id")))
    sizes = dealt(uneven, 2_000).groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in sizes) == 10_000 and max(r["count"] for r in sizes) <= 2_000

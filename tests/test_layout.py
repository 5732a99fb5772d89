"""Clustered files, SQL table functions, a stateful confusion matrix, a split that reads its input once."""

import pytest
from pyspark.sql import functions as F

from quillmark.functions.sql import register_table_functions
from quillmark.operators import corpus, evaluation
from quillmark.operators.splits import exact_split
from quillmark.profiles import LATIN
from quillmark.sources import layout, streams
from quillmark.sources.scratch import scratch_dir
from quillmark.streaming import scoring


def nodes(plan):
    """All physical nodes below one, adaptive wrappers opened."""
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return nodes(plan.executedPlan())
    if plan.getClass().getSimpleName().endswith("QueryStageExec"):
        return nodes(plan.plan())
    children = plan.children()
    return [plan, *(n for i in range(children.size()) for n in nodes(children.apply(i)))]


def scanned(df):
    """Files and rows that the scan of the data read."""
    df.collect()
    scans = [n for n in nodes(df._jdf.queryExecution().executedPlan()) if "FileSourceScan" in n.getClass().getSimpleName()]
    read = [(s.metrics().apply("numFiles").value(), s.metrics().apply("numOutputRows").value()) for s in scans]
    return max(read, key=lambda r: r[1])


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_a_range_reads_few_files_and_row_groups(spark):
    path = scratch_dir(spark, "clustered")
    df = spark.range(200_000).selectExpr("(id * 7919) % 200000 AS k", "CAST(id AS string) AS text")
    index = layout.write_clustered(df, path, "k", parts=8, group_bytes=64 << 10)
    assert index.count() == 8 and index.agg(F.sum("n")).first()[0] == 200_000
    found = layout.read_between(spark, path, "k", 30_000, 31_000)
    files, rows = scanned(found)
    assert files <= 2 and 1_001 <= rows < 20_000  # one part of 25,000 rows or two, and row groups of it
    assert rows_of(found) == rows_of(df.filter("k BETWEEN 30000 AND 31000"))
    assert layout.read_between(spark, path, "k").count() == 200_000
    assert layout.read_between(spark, path, "k", low=199_990).count() == 10
    assert layout.read_between(spark, path, "k", high=-1).count() == 0


def test_a_value_of_a_third_of_all_rows_fills_several_parts(spark):
    path = scratch_dir(spark, "clustered-hot")
    df = spark.range(30_000).selectExpr("IF(id % 3 = 0, 500, id % 1000) AS k", "id")
    index = layout.write_clustered(df, path, "k", parts=12).collect()
    assert max(r["n"] for r in index) < 5_000 and sum(r["low"] <= 500 <= r["high"] for r in index) >= 3
    assert layout.read_between(spark, path, "k", 500, 500).count() == df.filter("k = 500").count()


def test_nulls_and_empty_tables_keep_their_columns(spark):
    path = scratch_dir(spark, "clustered-null")
    df = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b"), (3, None)], "k int, low string")
    index = layout.write_clustered(df, path, "k", parts=2)
    assert index.filter("has_null").count() == 1
    assert rows_of(layout.read_between(spark, path, "k")) == [(1, "b"), (1, "b"), (3, None)]
    empty = scratch_dir(spark, "clustered-empty")
    assert layout.write_clustered(df.limit(0), empty, "k").count() == 0
    found = layout.read_between(spark, empty, "k", 0, 9)
    assert found.columns == ["k", "low"] and found.count() == 0


def test_table_functions_are_inlined(spark):
    texts = [(1, "the cat sat on the mat"), (2, ""), (3, None), (4, "a b cat"), (5, "the cat sat on the mat")]
    docs = spark.createDataFrame(texts, "id int, processed_text string")
    docs.createOrReplaceTempView("few")
    assert register_table_functions(spark, LATIN) == ["qm_tokens", "qm_bigrams", "qm_terms"]
    got = spark.sql("SELECT id, kind, term FROM few, LATERAL qm_terms(processed_text)")
    assert rows_of(got) == rows_of(corpus.explode_terms(docs, profile=LATIN, keep=("id",)))
    text = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in text and "Join" not in text and "Exchange" not in text and "Python" not in text
    assert rows_of(spark.sql("SELECT id, pos, token FROM few, LATERAL qm_tokens(processed_text) WHERE id = 4")) == [(4, 0, "a"), (4, 1, "b"), (4, 2, "cat")]
    assert rows_of(spark.sql("SELECT id, pos, bigram FROM few, LATERAL qm_bigrams(processed_text) WHERE id = 4")) == [(4, 0, "a b"), (4, 1, "b cat")]


def test_confusion_goes_on_after_a_restart(spark):
    root = scratch_dir(spark, "confusion")
    rows = spark.range(60).selectExpr("CAST(id AS string) AS text", "IF(id % 5 = 0, NULL, CAST(id % 2 AS int)) AS true_label")
    predicted = F.when(F.col("text").cast("int") % 7 != 0, F.col("text").cast("int") % 3 % 2)
    start = lambda: scoring.run_confusion(
        streams.stream_json_files(spark, f"{root}/in", 1).withColumn("predicted_label", predicted), f"{root}/out", f"{root}/manifest", f"{root}/cp"
    ).awaitTermination()
    want = lambda df: rows_of(evaluation.confusion_matrix(df.withColumn("prediction", predicted), "true_label"))
    first, rest = rows.filter("CAST(text AS int) < 25"), rows.filter("CAST(text AS int) >= 25")
    first.repartition(3).write.mode("append").json(f"{root}/in")
    start()
    assert rows_of(scoring.latest_confusion(spark, f"{root}/manifest")) == want(first)
    start()  # nothing new
    rest.repartition(2).write.mode("append").json(f"{root}/in")
    start()
    assert rows_of(scoring.latest_confusion(spark, f"{root}/manifest")) == want(rows)


@pytest.mark.parametrize("keep, most", [(True, 1), (False, 2)])
def test_an_exact_split_does_not_repeat_its_input(spark, keep, most):
    calls = spark.sparkContext.accumulator(0)
    rows = spark.createDataFrame([(i, i % 2) for i in range(101)], "id int, category_encode int").rdd

    def seen(row):
        calls.add(1)
        return row

    df = spark.createDataFrame(rows.map(seen), "id int, category_encode int")
    found = exact_split(df, "id", path=scratch_dir(spark, "split") if keep else None)
    assert rows_of(found.groupBy("category_encode", "split").count()) == [
        (0, "test", 8), (0, "train", 36), (0, "val", 7), (1, "test", 7), (1, "train", 35), (1, "val", 8)
    ]
    assert calls.value <= most * 101

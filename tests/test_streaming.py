"""Streams: equal to batch, once per message, restart, monitor, scratch folder."""

import pytest

from checks import tables
from checks.model_queries import _drop, _pipeline
from quillmark.operators.reshape import prediction_view
from quillmark.plans.preparation import add_style
from quillmark.profiles import LATIN
from quillmark.sources import streams
from quillmark.sources.scratch import scratch_dir
from quillmark.streaming import scoring

KNOWN = ["text_preview", "true_label", "predicted_label", "p_human", "short_words_ratio", "total_physical_lines", "foreign_letters_count"]


@pytest.fixture(scope="module")
def messages(spark, sf_dir):
    return tables.messages(spark, sf_dir).select("text", "true_label").cache()


def test_stream_equals_batch_and_shows_each_batch(spark, sf_dir, messages):
    root, model, seen = scratch_dir(spark, "stream"), _pipeline(spark, sf_dir), []
    _drop(messages, f"{root}/in", files=3)
    stream = scoring.stream_score(streams.stream_json_files(spark, f"{root}/in", 1), model, LATIN)
    scoring.run_stream(
        stream, f"{root}/out", f"{root}/cp", every=None, monitor=lambda b, i: seen.append((i, b.count())), progress=f"{root}/log"
    )
    got = spark.read.parquet(f"{root}/out").select(KNOWN)
    batch = prediction_view(model.transform(add_style(messages, LATIN))).select(KNOWN)
    assert got.exceptAll(batch).count() == 0 and batch.exceptAll(got).count() == 0
    assert [i for i, _ in seen] == [0, 1, 2] and all(0 < n <= 10 for _, n in seen)
    summary = scoring.progress_summary(scoring.stream_progress(spark, f"{root}/log")).first()
    assert (summary["n_batches"], summary["n_rows"]) == (3, messages.count())
    assert summary["first_batch_ms"] > 0 and summary["rows_per_second"] > 0


def test_progress_of_more_batches_than_spark_remembers(spark):
    root = scratch_dir(spark, "many")
    rows = spark.range(130).selectExpr("CAST(id AS string) AS text", "CAST(id % 2 AS int) AS true_label", "id")
    rows.repartitionByRange(130, "id").drop("id").write.json(f"{root}/in")
    files = spark.read.json(f"{root}/in").inputFiles()
    stream = streams.stream_json_files(spark, f"{root}/in", 1)
    query = scoring.run_stream(stream, f"{root}/out", f"{root}/cp", every=None, progress=f"{root}/log")
    assert len(query.recentProgress) <= 100 < len(files)
    progress = scoring.stream_progress(spark, f"{root}/log")
    summary = scoring.progress_summary(progress).first()
    assert (summary["n_batches"], summary["n_rows"]) == (len(files), 130)
    assert summary["first_batch_ms"] == progress.orderBy("batch_id").first()["duration_ms"] > 0


def test_monitor_sink_keeps_rows_of_another_checkpoint(spark):
    root = scratch_dir(spark, "two-checkpoints")
    spark.createDataFrame([(f"t{i}", 1) for i in range(20)], "text string, true_label int").write.json(f"{root}/in")
    run = lambda cp: scoring.run_stream(
        streams.stream_json_files(spark, f"{root}/in", 9), f"{root}/out", f"{root}/{cp}", every=None, monitor=lambda b, i: None
    )
    counts = []
    for checkpoint in ("a", "a", "b"):
        run(checkpoint)
        counts.append(scoring.stream_count(spark, f"{root}/out").first()["n_records"])
    assert counts == [20, 20, 40]


def test_restart_repeats_nothing(spark, sf_dir, messages):
    root, model = scratch_dir(spark, "restart"), _pipeline(spark, sf_dir)

    def run():
        stream = scoring.stream_score(streams.stream_json_files(spark, f"{root}/in", 2), model, LATIN)
        scoring.run_stream(stream, f"{root}/out", f"{root}/cp", every=None)
        return scoring.stream_count(spark, f"{root}/out").first()["n_records"]

    _drop(messages, f"{root}/in", files=2)
    assert run() == messages.count()
    assert run() == messages.count()
    _drop(messages, f"{root}/in", files=2)
    assert run() == 2 * messages.count()


def test_timed_run_stops(spark, sf_dir, messages):
    root = scratch_dir(spark, "timed")
    _drop(messages, f"{root}/in", files=1)
    stream = scoring.stream_features(streams.stream_json_files(spark, f"{root}/in"), LATIN)
    query = scoring.run_stream(stream, f"{root}/out", f"{root}/cp", every="1 second", run_seconds=8)
    assert not query.isActive
    assert scoring.stream_count(spark, f"{root}/out").first()["n_records"] == messages.count()


def test_decode_messages(spark):
    df = spark.createDataFrame([(bytearray(b'{"text":"a","true_label":1}'),), (bytearray(b"{bad"),)], "value binary")
    assert [tuple(r) for r in streams.decode_messages(df).collect()] == [("a", 1), (None, None)]


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        streams.stream_kafka(spark, "localhost:9092", "t")


def test_scratch_is_under_the_folder_the_session_names(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first.startswith(root) and first != second


def _numbers(spark, path, files, first=0):
    rows = spark.range(first, first + 3 * files).selectExpr("CAST(id AS string) AS text", "CAST(id % 2 AS int) AS true_label", "id")
    rows.repartitionByRange(files, "id").drop("id").write.mode("append").json(path)


def _scored(spark, path):
    from pyspark.sql import functions as F

    read = streams.stream_json_files(spark, path, 1)
    return read.select(F.col("text").alias("text_preview"), "true_label", (F.length("text") % 2).alias("predicted_label"))


def test_progress_of_two_streams_is_kept_apart(spark):
    root = scratch_dir(spark, "two-streams")
    _numbers(spark, f"{root}/a", 6)
    _numbers(spark, f"{root}/b", 3)
    log = streams.ProgressLog(spark, f"{root}/log")
    spark.streams.addListener(log)
    try:
        ours = streams.write_predictions(_scored(spark, f"{root}/a"), f"{root}/out-a", f"{root}/cp-a")
        log.follow(ours)
        other = streams.write_predictions(_scored(spark, f"{root}/b"), f"{root}/out-b", f"{root}/cp-b")
        ours.awaitTermination()
        other.awaitTermination()
        log.finish(ours)
    finally:
        spark.streams.removeListener(log)
    rows = spark.read.schema(streams.PROGRESS_SCHEMA).json(f"{root}/log").collect()
    assert {r["id"] for r in rows} == {str(ours.id)}
    summary = scoring.progress_summary(scoring.stream_progress(spark, f"{root}/log", str(ours.id))).first()
    assert (summary["n_batches"], summary["n_rows"]) == (6, 18)


def test_listed_batches_are_exact_after_a_batch_that_dies_before_its_commit(spark):
    root = scratch_dir(spark, "listed")
    _numbers(spark, f"{root}/in", 3)
    spark.createDataFrame([("not json",)], "value string").coalesce(1).write.mode("append").text(f"{root}/in")
    died = []

    def die_once(batch, batch_id):
        if batch_id == 1 and not died:
            died.append(batch.count())
            raise RuntimeError("the driver dies here")

    run = lambda monitor: streams.write_listed(
        _scored(spark, f"{root}/in"), f"{root}/out", f"{root}/manifest", f"{root}/cp", None, scoring.prediction_metrics(), monitor
    )
    with pytest.raises(Exception, match="dies here"):
        run(die_once).awaitTermination()
    run(None).awaitTermination()
    _numbers(spark, f"{root}/in", 2, first=100)
    run(None).awaitTermination()
    assert len(died) == 1 and spark.read.schema(streams.MANIFEST_SCHEMA).json(f"{root}/manifest").count() == 7
    batches = streams.listed_batches(spark, f"{root}/manifest").collect()
    assert sorted(b["batch_id"] for b in batches) == [0, 1, 2, 3, 4, 5]
    sums = {r["metric"]: r["n"] for r in scoring.listed_metrics(spark, f"{root}/manifest").groupBy("metric").sum("n").toDF("metric", "n").collect()}
    assert (sums["rows"], sums["without_text"], sums["predicted_1"] + sums["predicted_0"]) == (16, 1, 15)
    assert scoring.listed_count(spark, f"{root}/manifest").first()[0] == 16
    rows = streams.read_listed(spark, f"{root}/manifest", "text_preview string, true_label int, predicted_label int")
    assert rows.count() == 16 and rows.distinct().count() == 16
    assert spark.read.parquet(f"{root}/out").count() > 16  # the dead attempt's folder is there, unlisted
    last = {(r["label"], r["predicted"]): r["n"] for r in scoring.running_confusion(spark, f"{root}/manifest").orderBy("batch_id").collect()}
    truth = rows.dropna().groupBy("true_label", "predicted_label").count().collect()
    assert {k: v for k, v in last.items() if v} == {(r[0], r[1]): r[2] for r in truth}


def test_progress_has_batches_whose_event_was_lost(spark):
    root = scratch_dir(spark, "lost")
    _numbers(spark, f"{root}/in", 3)
    scoring.run_stream(_scored(spark, f"{root}/in"), f"{root}/out", f"{root}/cp", every=None, progress=f"{root}/log", manifest=f"{root}/manifest")
    kept = spark.read.schema(streams.PROGRESS_SCHEMA).json(f"{root}/log").filter("batch_id <> 1")
    kept.write.json(f"{root}/rest")
    rows = {r["batch_id"]: (r["rows"], r["duration_ms"]) for r in scoring.stream_progress(spark, f"{root}/rest", manifest=f"{root}/manifest").collect()}
    assert {k: v[0] for k, v in rows.items()} == {0: 3, 1: 3, 2: 3} and rows[1][1] is None and rows[0][1] > 0

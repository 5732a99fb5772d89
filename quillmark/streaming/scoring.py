"""Scoring of live messages with the transformations of the batch."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from quillmark.operators.reshape import prediction_view
from quillmark.plans.preparation import add_style
from quillmark.profiles import ARABIC, LanguageProfile
from quillmark.sources.streams import PROGRESS_SCHEMA, ProgressLog, listed_batches, read_listed, write_listed, write_predictions, write_with_monitor


def stream_features(df: DataFrame, profile: LanguageProfile = ARABIC) -> DataFrame:
    """Cleaned texts and style measures of a stream of messages: the batch expressions. A batch is dealt over the tasks."""
    return add_style(df, profile, deal=True)


def stream_score(df: DataFrame, model: PipelineModel, profile: LanguageProfile = ARABIC) -> DataFrame:
    """The output columns of scored messages."""
    return prediction_view(model.transform(stream_features(df, profile)))


def run_stream(
    df: DataFrame,
    out: str,
    checkpoint: str,
    every: str | None = "5 seconds",
    run_seconds: float | None = None,
    monitor=None,
    show: bool = False,
    progress: str | None = None,
    manifest: str | None = None,
    metrics: dict[str, Column] | None = None,
) -> StreamingQuery:
    """Write a scored stream, for ``run_seconds`` or, without it, until it ends.

    ``every=None`` works off what is there. ``show`` or ``monitor`` adds a look at each batch.
    A run that starts again with its checkpoint goes on where it stopped. ``progress`` is a folder to which
    the progress of every batch is appended. With ``manifest``, batches are listed there with their ``metrics``.
    """
    log = ProgressLog(df.sparkSession, progress) if progress else None
    if log:
        df.sparkSession.streams.addListener(log)
    if manifest:
        query = write_listed(df, out, manifest, checkpoint, every, metrics, monitor)
    elif show or monitor:
        query = write_with_monitor(df, out, checkpoint, every, monitor)
    else:
        query = write_predictions(df, out, checkpoint, every)
    if log:
        log.follow(query)
    try:
        ended = query.awaitTermination(run_seconds) if run_seconds else query.awaitTermination()
        if run_seconds and not ended:
            query.stop()
    finally:
        if log:
            log.finish(query)
            df.sparkSession.streams.removeListener(log)
    return query


def stream_count(spark: SparkSession, path: str) -> DataFrame:
    """Records in a sink."""
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_records"))


def prediction_metrics(label: str = "true_label", predicted: str = "predicted_label") -> dict[str, Column]:
    """Counts of a scored batch: messages without a text (unreadable JSON among them), predictions, and the confusion matrix."""
    no_text = {"without_text": F.count_if(F.col("text_preview").isNull())}
    classes = {f"predicted_{p}": F.count_if(F.col(predicted) == p) for p in (0, 1)}
    pairs = {f"label_{t}_predicted_{p}": F.count_if((F.col(label) == t) & (F.col(predicted) == p)) for t in (0, 1) for p in (0, 1)}
    return {**no_text, **classes, **pairs}


def listed_metrics(spark: SparkSession, manifest: str, id: str | None = None) -> DataFrame:
    """``(batch_id, metric, n)`` of every listed batch, exact after restarts: a repeated batch counts once."""
    return listed_batches(spark, manifest, id).select("batch_id", F.explode("metrics").alias("metric", "n"))


def listed_count(spark: SparkSession, manifest: str) -> DataFrame:
    """Records in a listed sink, without reading it."""
    rows = listed_batches(spark, manifest).agg(F.coalesce(F.sum(F.col("metrics")["rows"]), F.lit(0)).alias("n_records"))
    return rows


def running_confusion(spark: SparkSession, manifest: str) -> DataFrame:
    """``(batch_id, label, predicted, n)``: the confusion matrix of all batches up to each one."""
    parts = listed_metrics(spark, manifest).select(
        "batch_id", F.regexp_extract("metric", r"^label_(\d)_predicted_(\d)$", 1).alias("label"),
        F.regexp_extract("metric", r"^label_(\d)_predicted_(\d)$", 2).alias("predicted"), "n",
    ).filter("label <> ''")
    so_far = Window.partitionBy("label", "predicted").orderBy("batch_id")
    return parts.select("batch_id", F.col("label").cast("int"), F.col("predicted").cast("int"), F.sum("n").over(so_far).alias("n"))


def stream_confusion(scored: DataFrame, label: str = "true_label", predicted: str = "predicted_label") -> DataFrame:
    """``(label, prediction, n)`` of all scored messages so far, kept in Spark's state store.

    Works on a stream and on a batch. Messages without a label or a prediction of 0 or 1 are left out. Each task adds
    up its own rows before the shuffle, so four cells are four rows a task, however many messages share one.
    """
    known = scored.select(F.col(label).cast("int").alias("label"), F.col(predicted).cast("int").alias("prediction"))
    cells = known.filter(F.col("label").isin(0, 1) & F.col("prediction").isin(0, 1))
    return cells.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))


def run_confusion(scored: DataFrame, out: str, manifest: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Start keeping the confusion matrix of a scored stream: every batch writes and lists the cells it changed.

    A run that starts again with its checkpoint goes on with the counts of its state store.
    """
    return write_listed(stream_confusion(scored), out, manifest, checkpoint, every, mode="update")


def latest_confusion(spark: SparkSession, manifest: str) -> DataFrame:
    """``(label, prediction, n)`` after the last listed batch, all four cells, 0 where empty.

    Counts only grow, so a cell's largest listed one is its last. One checkpoint has one manifest.
    """
    cells = read_listed(spark, manifest, "label int, prediction int, n long").groupBy("label", "prediction").agg(F.max("n").alias("n"))
    every = spark.sql("SELECT * FROM VALUES (0, 0), (0, 1), (1, 0), (1, 1) AS cells(label, prediction)")
    return every.join(cells, ["label", "prediction"], "left").select("label", "prediction", F.coalesce("n", F.lit(0)).alias("n"))


def stream_progress(spark: SparkSession, path: str, id: str | None = None, manifest: str | None = None) -> DataFrame:
    """``(batch_id, rows, duration_ms)`` of every batch with rows that runs of one checkpoint logged under ``path``.

    ``id`` is the query's, for a folder that several write to. A batch that ran again after a failure counts once,
    with its latest run. A driver that dies between a batch and its event loses the time; with ``manifest`` such a
    batch is there all the same, with its rows and without a time.
    """
    logged = spark.read.schema(PROGRESS_SCHEMA).json(path).filter(F.col("rows") > 0)
    logged = logged if id is None else logged.filter(F.col("id") == id)
    latest = logged.groupBy("batch_id").agg(F.max_by(F.struct("rows", "duration_ms"), "at").alias("last"))
    found = latest.select("batch_id", "last.rows", "last.duration_ms")
    if manifest is None:
        return found
    listed = listed_batches(spark, manifest, id).select("batch_id", F.col("metrics")["rows"].alias("listed")).filter("listed > 0")
    return listed.join(found, "batch_id", "full").select("batch_id", F.coalesce("listed", "rows").alias("rows"), "duration_ms")


def progress_summary(progress: DataFrame) -> DataFrame:
    """Batches, rows, first and mean later batch time, and rows per second."""
    first = F.min_by("duration_ms", "batch_id")
    total_ms = F.sum("duration_ms")
    return progress.agg(
        F.count(F.lit(1)).alias("n_batches"),
        F.sum("rows").alias("n_rows"),
        first.alias("first_batch_ms"),
        F.try_divide(total_ms - first, F.count(F.lit(1)) - 1).alias("steady_batch_ms"),
        F.try_divide(F.sum("rows") * 1000.0, total_ms).alias("rows_per_second"),
    )

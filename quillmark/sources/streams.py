"""Streaming sources and sinks."""

from __future__ import annotations

import threading
import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

MESSAGE_SCHEMA = "text string, true_label int"
MANIFEST_SCHEMA = "id string, batch_id long, path string, at double, metrics map<string, long>"
PROGRESS_SCHEMA = "id string, run string, batch_id long, rows long, duration_ms long, at string"


def stream_json_files(spark: SparkSession, directory: str, max_files: int = 1) -> DataFrame:
    """Messages from JSON-lines files dropped into a folder."""
    return spark.readStream.schema(MESSAGE_SCHEMA).option("maxFilesPerTrigger", max_files).json(directory)


def stream_kafka(spark: SparkSession, servers: str, topic: str, starting: str = "latest") -> DataFrame:
    """Messages from a Kafka topic. Needs the Kafka connector package on the class path."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
        .load()
    )
    return decode_messages(raw)


def decode_messages(df: DataFrame, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Message columns from a JSON value, binary or string; an unreadable one gives nulls."""
    data = F.from_json(F.col(value).cast("string"), MESSAGE_SCHEMA).alias("data")
    return df.select(*keep, data).select(*keep, "data.*")


def _trigger(every: str | None) -> dict:
    return {"processingTime": every} if every else {"availableNow": True}


class ProgressLog(StreamingQueryListener):
    """Writes the progress of every batch of one query as JSON lines, as soon as its event comes.

    Spark itself remembers the latest hundred. A listener hears all queries of its session: events of
    others are left out by the id that the query keeps in its checkpoint. Those that come before
    :meth:`follow` names the id wait for it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.id = spark, path, None
        self.waiting, self.ended, self.changed = [], set(), threading.Condition()

    def follow(self, query: StreamingQuery) -> None:
        with self.changed:
            self.id = str(query.id)
            self._write()

    def _write(self) -> None:
        rows, self.waiting = [r for r in self.waiting if r[0] == self.id], []
        if rows:
            self.spark.createDataFrame(rows, PROGRESS_SCHEMA).coalesce(1).write.mode("append").json(self.path)

    def finish(self, query: StreamingQuery, seconds: float = 60) -> None:
        """Wait for the events of an ended query, which come after its end."""
        with self.changed:
            self.changed.wait_for(lambda: str(query.runId) in self.ended, seconds)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        row = (str(p.id), str(p.runId), p.batchId, p.numInputRows, int(p.durationMs.get("triggerExecution", 0)), p.timestamp)
        with self.changed:
            if self.id in (None, row[0]):
                self.waiting.append(row)
            if self.id:
                self._write()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        with self.changed:
            self.ended.add(str(event.runId))
            self.changed.notify_all()


def write_predictions(df: DataFrame, out: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Append to Parquet, exactly once per message.

    ``every`` is a processing-time trigger such as ``"5 seconds"``; without it the query works off
    what is there and ends.
    """
    return (
        df.writeStream.outputMode("append")
        .format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(**_trigger(every))
        .start()
    )


def write_with_monitor(
    df: DataFrame, out: str, checkpoint: str, every: str | None = None, monitor=None, rows: int = 10
) -> StreamingQuery:
    """Like :func:`write_predictions`, and show ``rows`` rows of each batch, scoring it once.

    Each batch goes to its own folder ``run=<query>/batch=<id>``, so a batch repeated after a failure
    replaces itself. The run is the id that the checkpoint holds: batches of another checkpoint never
    touch it. What the monitor shows is read back from there: no batch has to stay in memory.
    ``monitor`` takes a DataFrame and the batch id; the default prints.
    """
    show = monitor or (lambda batch, _: batch.show(rows, truncate=False))

    def both(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]
        path = f"{out}/run={run}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(path)
        show(batch.sparkSession.read.schema(batch.schema).parquet(path).limit(rows), batch_id)

    return (
        df.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint).trigger(**_trigger(every)).start()
    )


def write_listed(
    df: DataFrame,
    out: str,
    manifest: str,
    checkpoint: str,
    every: str | None = None,
    metrics: dict[str, Column] | None = None,
    monitor=None,
    rows: int = 10,
    mode: str = "append",
) -> StreamingQuery:
    """Write each batch to a new folder and then list it, with its metrics, in a manifest that is only added to.

    ``metrics`` are aggregates of a batch (all counts), observed while it is written, so that they cost no other pass;
    ``rows`` is always among them. A batch is listed before its checkpoint commits it: a driver that dies in
    between repeats it, and readers take the latest listing of each batch, whose folder is complete. What a dying
    or repeated batch leaves half-written is never listed, and listed folders are never written again. ``mode``
    is the output mode: a stream with an aggregation needs ``update`` or ``complete``.
    """
    wanted = {"rows": F.count(F.lit(1)), **(metrics or {})}

    def both(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = spark.read.schema("id string").json(f"{checkpoint}/metadata").first()["id"]
        path = f"{out}/run={own}/batch={batch_id}/attempt={uuid.uuid4().hex}"
        seen = Observation()
        batch.observe(seen, *(c.cast("long").alias(n) for n, c in wanted.items())).write.parquet(path)
        counts = {n: int(v or 0) for n, v in seen.get.items()}
        listed = spark.createDataFrame([(own, batch_id, path, time.time(), counts)], MANIFEST_SCHEMA)
        listed.coalesce(1).write.mode("append").json(manifest)
        if monitor:
            monitor(spark.read.schema(batch.schema).parquet(path).limit(rows), batch_id)

    writer = df.writeStream.foreachBatch(both).outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.trigger(**_trigger(every)).start()


def listed_batches(spark: SparkSession, manifest: str, id: str | None = None) -> DataFrame:
    """``(id, batch_id, path, metrics)``: the latest listing of each batch, of one query or of all."""
    rows = spark.read.schema(MANIFEST_SCHEMA).json(manifest)
    rows = rows if id is None else rows.filter(F.col("id") == id)
    last = F.max_by(F.struct("path", "metrics"), F.struct("at", "path")).alias("last")
    return rows.groupBy("id", "batch_id").agg(last).select("id", "batch_id", "last.*")


def read_listed(spark: SparkSession, manifest: str, schema) -> DataFrame:
    """Rows of the listed batches and of no other folder. The driver sees one path per batch."""
    paths = [r["path"] for r in listed_batches(spark, manifest).collect()]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

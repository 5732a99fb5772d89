"""Counts in bucketed tables: merging increments needs no exchange.

Every increment is a table of its own, bucketed and sorted by its key with the same number of buckets. A join of
two such tables reads bucket with bucket. The tables lie in the session's warehouse or under ``path``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = ("type", "key")


def _save(counts: DataFrame, table: str, buckets: int, path: str | None) -> DataFrame:
    writer = counts.write.mode("overwrite").bucketBy(buckets, *KEY).sortBy(*KEY)
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return counts.sparkSession.table(table)


def save_counts(counts: DataFrame, table: str, buckets: int = 64, path: str | None = None) -> DataFrame:
    """Store ``(type, key, count)`` as a bucketed table; equal keys are added up first, so that a key is one row."""
    return _save(counts.groupBy(*KEY).agg(F.sum("count").alias("count")), table, buckets, path)


def add_stored(spark: SparkSession, a: str, b: str) -> DataFrame:
    """``(type, key, count)`` over two stored increments, bucket by bucket. Keys are never null."""
    more = spark.table(b).withColumnRenamed("count", "more")
    both = spark.table(a).join(more, list(KEY), "full")
    return both.select(*KEY, (F.coalesce("count", F.lit(0)) + F.coalesce("more", F.lit(0))).alias("count"))


def merge_stored(spark: SparkSession, tables: list[str], buckets: int = 64, path: str | None = None) -> DataFrame:
    """``(type, key, count)`` over all stored increments.

    Two are merged at a time. What a merge gives is stored as a bucketed table again while there are more than
    two, since a full join's keys are not known to lie in their buckets.
    """
    if not tables:
        raise ValueError("no increment to merge")
    left = list(tables)
    while len(left) > 2:
        name = f"merged_{uuid.uuid4().hex}"
        _save(add_stored(spark, left[0], left[1]), name, buckets, path and f"{path}/{name}")
        left = [*left[2:], name]
    return add_stored(spark, *left) if len(left) == 2 else spark.table(left[0]).select(*KEY, "count")

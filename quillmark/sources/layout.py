"""Clustered files: a range filter or a join with a small table reads the folders it needs, and of their files the row groups.

Rows are dealt over parts by ranges of a column and sorted within them. An index table holds the least and the
greatest value of each part. Reading a range joins with the index, whose parts Spark turns into partition
pruning while the query runs; within the files, row-group statistics skip the rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PART = "_part"


def write_clustered(df: DataFrame, path: str, by: str, parts: int = 64, group_bytes: int | None = None) -> DataFrame:
    """Write ``df`` below ``path`` in about ``parts`` folders of ascending ``by``; return the index.

    The index has one row per part: ``(_part, low, high, has_null, n)``. Equal values are dealt by a hash of the
    row, so that a value that makes up a third of all rows fills several parts and is no task's burden. Nulls come
    first. ``group_bytes`` is the size of a row group; Spark's default is 128 MB. An empty table gives an empty index.
    """
    if PART in df.columns:
        raise ValueError(f"a column is called {PART}")
    column, tie = F.col(f"`{by}`"), F.xxhash64(*(F.col(f"`{c}`") for c in df.columns))
    ranged = df.repartitionByRange(parts, column, tie).withColumn(PART, F.spark_partition_id())
    writer = ranged.sortWithinPartitions(PART, column).write.mode("overwrite").partitionBy(PART)
    (writer.option("parquet.block.size", group_bytes) if group_bytes else writer).parquet(f"{path}/data")
    ranged.limit(0).write.mode("overwrite").parquet(f"{path}/columns")  # known even where no part is written
    data = _data(df.sparkSession, path)
    sides = (F.min(column).alias("low"), F.max(column).alias("high"), F.max(column.isNull()).alias("has_null"))
    index = data.groupBy(PART).agg(*sides, F.count(F.lit(1)).alias("n"))
    index.coalesce(1).write.mode("overwrite").parquet(f"{path}/index")  # one row per part
    return df.sparkSession.read.schema(index.schema).parquet(f"{path}/index")


def _data(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(spark.read.parquet(f"{path}/columns").schema).parquet(f"{path}/data")


def read_between(spark: SparkSession, path: str, by: str, low=None, high=None) -> DataFrame:
    """Rows of a clustered table with ``low <= by <= high``; an open side has no limit, and nulls are never in a range."""
    column, index = F.col(f"`{by}`"), spark.read.parquet(f"{path}/index")
    data = _data(spark, path)
    wanted, parts = column.isNotNull(), F.col("low").isNotNull()
    if low is not None:
        wanted, parts = wanted & (column >= F.lit(low)), parts & (F.col("high") >= F.lit(low))
    if high is not None:
        wanted, parts = wanted & (column <= F.lit(high)), parts & (F.col("low") <= F.lit(high))
    return data.filter(wanted).join(index.filter(parts).select(PART), PART, "left_semi").drop(PART)

"""Where intermediate tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession, name: str, root: str | None = None) -> str:
    """A new path under ``root``, else under the folder that ``spark.checkpoint.dir`` names.

    The folder must be one that every executor reaches. A session without the setting uses its
    warehouse folder, which executors share as well. No folder of one machine is ever made up here,
    and no setting is written.
    """
    settings = spark.sparkContext.getConf()
    root = root or spark.conf.get("spark.checkpoint.dir", None) or settings.get("spark.checkpoint.dir")
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """``df`` written to ``path`` and read back: evaluated once, and a lost executor costs a re-read."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.parquet(path)

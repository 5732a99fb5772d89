"""The given tables in the shapes the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.sql import ARABIC_STAND_INS, LATIN_LETTERS
from quillmark.operators.labels import attach_labels
from quillmark.plans.preparation import add_clean_texts, add_style
from quillmark.profiles import ARABIC, LATIN


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")


def latin_docs(spark, sf_dir) -> DataFrame:
    """Documents with ``subset`` and, where labelled, ``category_encode``."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("category_encode"))
    docs = documents(spark, sf_dir).withColumnRenamed("source", "subset")
    return attach_labels(docs, labels, how="left")


def arabic_docs(spark, sf_dir) -> DataFrame:
    """The same with the texts in Arabic letters."""
    return latin_docs(spark, sf_dir).withColumn("text", F.translate(F.lower("text"), LATIN_LETTERS, ARABIC_STAND_INS))


def processed(spark, sf_dir) -> DataFrame:
    """Arabic corpus with cleaned and processed texts."""
    return add_clean_texts(arabic_docs(spark, sf_dir), ARABIC)


def styled(spark, sf_dir) -> DataFrame:
    """Latin corpus with all style measures."""
    return add_style(latin_docs(spark, sf_dir), LATIN)


def wide(spark, sf_dir) -> DataFrame:
    """One row per turn of a conversation with its text in the column of its role: every text takes part."""
    roles = ("user", "assistant", "system")
    texts = (F.when(F.col("role") == r, F.col("text")).alias(f"{r}_text") for r in roles)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", *texts)


def _hash_share(key, digits: int):
    return F.conv(F.substring(F.md5(key), 1, digits), 16, 10).cast("bigint") / F.lit(16**digits)


def scored(spark, sf_dir) -> DataFrame:
    """Labels with a score that both engines derive from the document id."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("category_encode"))
    with_score = labels.withColumn("score", _hash_share(F.concat(F.lit("score-"), F.col("doc_id").cast("string")), 2))
    return with_score.withColumn("prediction", F.when(F.col("score") >= 0.5, 1.0).otherwise(0.0))


def runs(spark, sf_dir) -> DataFrame:
    """Scores of three models on two splits."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("category_encode"))
    names = lambda *values: F.explode(F.array(*map(F.lit, values)))
    each = labels.withColumn("model", names("m1", "m2", "m3")).withColumn("split", names("val", "test"))
    key = F.concat_ws("-", "model", "split", F.col("doc_id").cast("string"))
    return each.withColumn("score", _hash_share(key, 4)).withColumn(
        "prediction", F.when(F.col("score") >= 0.4, 1.0).otherwise(0.0)
    )


def messages(spark, sf_dir) -> DataFrame:
    """Conversation turns as labelled messages: user 1, assistant 0, others without a label."""
    label = F.when(F.col("role") == "user", 1).when(F.col("role") == "assistant", 0)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "text", label.alias("true_label"))

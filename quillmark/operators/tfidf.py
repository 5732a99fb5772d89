"""TF-IDF as an explicit table, without hashing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.sources.scratch import scratch_dir, stored


def _terms(df: DataFrame, tokens: str, *keep: str) -> DataFrame:
    """One row per array element.

    The outer form and a filter on its result, because the plain one adds a filter on the array
    itself, which makes Spark tokenize each text twice.
    """
    return df.select(*keep, F.explode_outer(tokens).alias("term")).filter("term IS NOT NULL")


def term_frequencies(df: DataFrame, doc: str, tokens: str = "tokens") -> DataFrame:
    """``(doc, term, tf)``: occurrences of each term in each document."""
    return _terms(df, tokens, doc).groupBy(doc, "term").agg(F.count(F.lit(1)).alias("tf"))


def document_frequency(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """``(term, df)``: documents that hold a term.

    A document names each of its terms once, so counting needs one shuffle of partial counts.
    """
    distinct = df.select(F.array_distinct(tokens).alias(tokens))
    return _terms(distinct, tokens).groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def tf_idf_table(
    df: DataFrame, doc: str, tokens: str = "tokens", min_doc_freq: int = 2, path: str | None = None
) -> DataFrame:
    """``(doc, term, tf, df, idf, weight)`` with idf = ln((documents + 1) / (df + 1)), 0 under ``min_doc_freq``.

    Term and document frequencies are stored below ``path`` (by default a scratch folder), so the texts
    are tokenized once. The join is keyed by the term. Both its sides are then plain exchanges, so Spark
    splits the partition of a term that is found in a large share of the documents at run time; with an
    aggregate on either side it would not.
    """
    path = path or scratch_dir(df.sparkSession, "tfidf")
    documents = df.agg(F.count(F.lit(1))).scalar()
    idf = F.when(F.col("df") >= min_doc_freq, F.log((documents + 1) / (F.col("df") + 1))).otherwise(0.0)
    tf = stored(term_frequencies(df, doc, tokens), f"{path}/tf")
    frequency = stored(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")), f"{path}/df")
    return (
        tf.join(frequency, "term")
        .withColumn("idf", idf)
        .withColumn("weight", F.col("tf") * F.col("idf"))
        .select(doc, "term", "tf", "df", "idf", "weight")
    )

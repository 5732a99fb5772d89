"""Joins of documents with their labels.

No side is broadcast by hint: Spark does so when its size estimate allows, and otherwise sorts
and merges, splitting skewed partitions at run time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def attach_labels(docs: DataFrame, labels: DataFrame, key: str = "doc_id", how: str = "inner") -> DataFrame:
    """Documents with their labels; ``how="left"`` keeps unlabelled ones."""
    return docs.join(labels, key, how)


def unlabelled(docs: DataFrame, labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents without a label."""
    return docs.join(labels, key, "left_anti")


def stopword_anti_join(tokens: DataFrame, stopwords: DataFrame, token: str = "token") -> DataFrame:
    """Token rows not in a stopword table, for lists too long to be a literal."""
    return tokens.join(stopwords.select(token), token, "left_anti").select(*tokens.columns)

"""Word rules and small helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.sources.scratch import scratch_dir

BLANK = r"[\x20\x09-\x0D]"
NOT_BLANK = r"[^\x20\x09-\x0D]"


def blank_words(text: Column) -> Column:
    """Words between ASCII white space, in order. Null gives null, a blank text an empty array."""
    return F.array_remove(F.split(text, f"{BLANK}++"), "")


def count_words(text: Column) -> Column:
    """Number of words between ASCII white space, without building them; null and blank give 0.

    Every word is cut down to one letter together with the white space around it.
    """
    marks = F.regexp_replace(text, f"{BLANK}*+{NOT_BLANK}++{BLANK}*+", "w")
    return F.when(text.rlike(NOT_BLANK), F.length(marks)).otherwise(0).cast("long")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written below the shared scratch folder and read back.

    Lost executors then cost a re-read and no recomputation, the size is known to the planner, and a
    join on the result is a bare exchange that Spark can split where a key is hot.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def packed(docs: DataFrame, *replaced: str, **needed: str) -> DataFrame:
    """The caller's columns in one struct, ``_row``, beside the needed ones under names of the operator's own.

    Whatever an operator adds can then neither overwrite nor meet a column of the caller's. Columns named like
    one of ``replaced``, the results, are left out. :func:`unpacked` brings the others back.
    """
    gone = {r.lower() for r in replaced}
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in gone]
    return docs.select(F.struct(*kept).alias("_row"), *(F.col(f"`{c}`").alias(n) for n, c in needed.items()))


def unpacked(rows: DataFrame, *results) -> DataFrame:
    """The caller's columns, then the results."""
    return rows.select("_row.*", *results)

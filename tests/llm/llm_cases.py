"""Rows that every operator must take: nulls, empty and very long texts, ties, repeats, clashing names."""

from pyspark.sql import functions as F

LONG = " ".join(f"word{i % 977}" for i in range(30_000))
ROWS = [
    (1, "the quick brown fox jumps over the lazy dog and runs away from here", "en", "a", 10),
    (1, "the quick brown fox jumps over the lazy dog and runs away from here", "en", "a", 10),
    (2, "The quick brown fox jumps over the lazy dog and runs away from here", "en", None, 10),
    (3, None, "en", "b", 10),
    (4, "", None, "b", 10),
    (5, " \t\n ", "en", "b", None),
    (None, "a row without an id but with words enough to be read by all", "en", "c", 10),
    (None, "a row without an id but with words enough to be read by all", "en", "c", 10),
    (7, LONG, "en", "c", 10),
    (8, "x" * 200_000, "en", "c", 10),
    (9, "café \U0001f600 naïve ▁   \x00 zK " * 3, "fr", "", 10),
    (10, "<s>[INST] </s> \\[INST] <\\s>", "en", "d", 10),
    (11, "same\nsame\nsame\n \nother", "en", "d", 10),
    (12, "one two three four five six one two three four five six one two three four five", "en", "d", 10),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("score", "kept", "size", "target", "copies", "n_words", "component_id", "fp", "ids", "rank", "hash", "words")


def documents(spark, rows=ROWS):
    """The rows, with further columns named like results and helpers."""
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return df.withColumns({c: F.lit("mine") for c in CLASHING})


def empty(spark):
    return documents(spark, []).limit(0)


def labels(spark):
    rows = [(i, 1 if i in (1, 2, 7) else 0, 0) for i in range(1, 13)] + [(None, 1, 0), (99, None, 0), (1, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def words(text):
    """Words between ASCII white space."""
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    """A-Z alone in lower case."""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")

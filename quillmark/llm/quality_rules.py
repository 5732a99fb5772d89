"""Quality rules: simple word rules, then a hashed n-gram log-likelihood ratio per document.

Two multinomials over hashed unigrams and bigrams are counted: one over all documents (raw), one over
trusted ones (target). A document's score is the mean over its n-grams of log p(target) - log p(raw);
documents below a fixed threshold go. The counts are one aggregation over bucket numbers, combined in
each task first. Scoring needs no shuffle: the ratios, one float per bucket, are a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.llm.text import NOT_BLANK, blank_words, packed, stored, unpacked

BUCKETS = 1 << 17
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def _shifted(array: Column, by: int) -> Column:
    """The array from its element ``by`` on, so that zipped arrays show neighbours side by side."""
    return F.slice(array, by + 1, F.greatest(F.size(array) - by, F.lit(0)))


def _zip(*arrays: Column) -> Column:
    return F.arrays_zip(*(a.alias(f"f{i}") for i, a in enumerate(arrays)))


def with_hashes(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``_words``, ``_hw``, the words' 64-bit hashes, and ``_hp``, those of neighbouring pairs; null texts have none."""
    words = blank_words(F.coalesce(F.col(text), F.lit("")))
    hashed = docs.withColumn("_words", words)
    hashed = hashed.withColumn("_hw", F.transform("_words", lambda w: F.xxhash64(w)))
    firsts = F.slice("_hw", 1, F.greatest(F.size("_hw") - 1, F.lit(0)))
    return hashed.withColumn("_hp", F.zip_with(firsts, _shifted(F.col("_hw"), 1), lambda a, b: F.xxhash64(a, b)))


def bucket(gram: Column, n_buckets: int = BUCKETS) -> Column:
    """Bucket number of the hash of a unigram or bigram."""
    return gram.bitwiseAND(F.lit(n_buckets - 1).cast("long")).cast("int")


def with_measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the measures of the word rules to rows that have ``_words``, ``_hw`` and ``_hp``.

    Windows of five words are compared by 64-bit hashes of two pairs and a word. A window that occurs twice
    repeats its four pairs, so texts with fewer repeated pairs make no windows. Only texts in which a window
    occurs twice sort them: equal ones become neighbours, and the words that the marked windows cover are
    counted from their positions.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    shifts = _zip(F.col("_hp"), _shifted(F.col("_hp"), 2), _shifted(F.col("_hw"), WINDOW - 1))
    windows = F.slice(shifts, 1, F.greatest(F.size("_hw") - (WINDOW - 1), F.lit(0)))
    enough = F.size("_hp") - F.size(F.array_distinct("_hp")) >= WINDOW - 1
    none = F.array().cast("array<bigint>")
    rows = docs.withColumn("_windows", F.when(enough, F.transform(windows, lambda s: F.xxhash64(s))).otherwise(none))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    positions = F.sequence(F.lit(0), F.size("_windows") - 1)
    rows = rows.withColumn("_sorted", F.when(repeats, F.sort_array(_zip(F.col("_windows"), positions))))
    found = F.col("_sorted.f0")
    before = F.concat(F.array(F.lit(None).cast("long")), found)
    neighbours = _zip(found, F.col("_sorted.f1"), _shifted(found, 1), before)
    marked = F.filter(neighbours, lambda s: (s["f0"] == s["f2"]) | (s["f0"] == s["f3"]))
    rows = rows.withColumn("_marked", F.sort_array(F.transform(marked, lambda s: s["f1"])))
    steps = _zip(F.col("_marked"), _shifted(F.col("_marked"), 1))
    new_words = lambda s: F.least(F.lit(WINDOW), F.coalesce(s["f1"] - s["f0"], F.lit(WINDOW)))
    covered = F.aggregate(steps, F.lit(0), lambda n, s: n + new_words(s))
    lines = F.filter(F.split(body, "\n"), lambda line: line.rlike(NOT_BLANK))
    rows = rows.withColumn("_lines", F.when(F.contains(body, F.lit("\n")), lines).otherwise(F.array().cast("array<string>")))
    n_words, n_repeat = F.size("_words"), F.coalesce(covered, F.lit(0))
    return rows.withColumns(
        {
            "n_words": n_words.cast("long"),
            "word_chars": F.length(F.array_join("_words", "")).cast("long"),
            "n_symbols": (F.length(body) - F.length(F.regexp_replace(body, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": n_repeat.cast("long"),
        }
    ).withColumn("base_failed", (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20))


def trusted_ids(labels: DataFrame, doc_id: str = "doc_id", quality: str = "quality") -> DataFrame:
    """Ids of all documents labelled 1."""
    return labels.filter(F.col(quality) == 1).select(F.col(doc_id).alias("_trusted_id")).dropna().distinct()


def count_buckets(
    docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text", n_buckets: int = BUCKETS
) -> DataFrame:
    """``(bucket, raw, target)``: n-gram counts of all documents and of all trusted ones.

    Ids and texts are dealt by id, so that no number of trusted ids has to fit the driver or a task.
    """
    narrow = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    flagged = narrow.join(trusted.hint("merge"), F.col("_id") == F.col("_trusted_id"), "left")
    each = with_hashes(flagged, "_text").select(
        F.col("_trusted_id").isNotNull().cast("int").alias("in_target"), F.explode(F.concat("_hw", "_hp")).alias("gram")
    )
    return each.groupBy(bucket(F.col("gram"), n_buckets).alias("bucket")).agg(
        F.count(F.lit(1)).alias("raw"), F.sum("in_target").alias("target")
    )


def bucket_ratios(counts: DataFrame, n_buckets: int = BUCKETS, smoothing: float = 1.0) -> DataFrame:
    """One row, ``ratios``: log p(target) - log p(raw) of each bucket, smoothed; zeros without trusted documents."""
    wide = F.lit(smoothing * n_buckets)
    every = counts.sparkSession.range(n_buckets).select(F.col("id").cast("int").alias("bucket"))
    known = every.join(counts, "bucket", "left").fillna(0, ["raw", "target"])
    row = known.groupBy().agg(
        F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("all"),
        F.sum("raw").alias("all_raw"),
        F.sum("target").alias("all_target"),
    )
    log_p = lambda n, total: F.log((n + smoothing) / (total + wide))
    ratio = lambda s: log_p(s["target"], F.col("all_target")) - log_p(s["raw"], F.col("all_raw"))
    ratios = F.transform("all", lambda s: F.when(F.col("all_target") > 0, ratio(s)).otherwise(0.0).cast("float"))
    return row.select(ratios.alias("ratios"))


def quality_rules(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = -0.3,
    n_buckets: int = BUCKETS,
) -> DataFrame:
    """``docs`` with the measures of the word rules, ``score`` and ``kept``.

    ``base_failed``: fewer than 10 words, or over a fifth of the words in five-word windows that occur
    twice. ``kept``: not failed, and ``score`` (mean log ratio per n-gram) is at least ``threshold``. Null
    and blank texts have no words, fail, and score 0. A null id is never trusted. Without trusted
    documents all scores are 0. Repeated rows count as often as they occur. Columns named like a result
    are replaced; an empty table gives an empty result.
    """
    counts = stored(count_buckets(docs, trusted_ids(labels), doc_id, text, n_buckets), "ngram-counts")
    ratios = stored(bucket_ratios(counts, n_buckets), "ngram-ratios")
    rows = with_hashes(packed(docs, *MEASURES, "score", "kept", text=text))
    rows = with_measures(rows).withColumn("_grams", F.concat("_hw", "_hp"))
    rows = rows.withColumn("_ratios", ratios.scalar())
    total = F.aggregate("_grams", F.lit(0.0), lambda s, g: s + F.get(F.col("_ratios"), bucket(g, n_buckets)))
    rows = rows.withColumn("score", total / F.greatest(F.size("_grams"), F.lit(1)))
    rows = rows.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
    return unpacked(rows, *MEASURES, "score", "kept")

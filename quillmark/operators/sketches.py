"""Mergeable sketches: quantiles, distinct types and frequent terms without a shuffle of all values.

A sketch is a binary column of bounded size. Stored per part of a corpus, sketches of new parts are merged with
the old ones without reading the old texts again. Frequent terms are only proposed by a sketch; they are
counted exactly, and the sketch's error bound proves that none is missing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.operators.ranking import top_n
from quillmark.operators.reshape import GENERATED, HUMAN
from quillmark.operators.summaries import LABEL
from quillmark.sources.scratch import scratch_dir, stored

QUANTILE_K = 400  # a KLL sketch of this size is within RANK_ERROR of the rank, 99 times in 100
RANK_ERROR = 0.007
THETA_LOG = 14  # 16,384 hashes: a relative standard error of 1/128
MOST_TRACKED = 1_000_000


def quantile_sketches(df: DataFrame, keys: list[str], cols: list[str], k: int = QUANTILE_K) -> DataFrame:
    """``(*keys, feature, sketch)`` from one pass: a KLL sketch of each column in each group. Nulls are left out."""
    made = df.groupBy(*keys).agg(*(F.kll_sketch_agg_double(F.col(f"`{c}`").cast("double"), k).alias(c) for c in cols))
    return made.unpivot(keys, cols, "feature", "sketch")


def merged_quantiles(sketches: DataFrame, keys: list[str], probs: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``(*keys, feature, prob, value)``: sketches of any number of parts merged. Groups without values give no row."""
    some = sketches.filter(F.kll_sketch_get_n_double("sketch") > 0)
    merged = some.groupBy(*keys, "feature").agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    asked = F.array(*(F.lit(float(p)) for p in probs))
    pairs = F.arrays_zip(asked.alias("prob"), F.kll_sketch_get_quantile_double("sketch", asked).alias("value"))
    return merged.select(*keys, "feature", F.explode(pairs).alias("pair")).select(*keys, "feature", "pair.*")


def type_sketches(terms: DataFrame, keys: list[str], term: str = "term", log_size: int = THETA_LOG) -> DataFrame:
    """``(*keys, types)``: a theta sketch of the distinct terms of each group."""
    return terms.groupBy(*keys).agg(F.theta_sketch_agg(term, log_size).alias("types"))


def class_types(sketches: DataFrame, keys: list[str], label: str = LABEL, log_size: int = THETA_LOG) -> DataFrame:
    """``(*keys, n_human, n_ai, n_both, n_shared)``: estimated distinct types of each class, of both together, and in both.

    Sketches of any number of parts are merged first; no text is read. A class without terms has no types.
    """
    of = lambda value: F.theta_union_agg(F.when(F.col(label) == value, F.col("types")), log_size)
    sides = sketches.groupBy(*keys).agg(of(HUMAN).alias("human"), of(GENERATED).alias("ai"))
    size = lambda sketch: F.theta_sketch_estimate(sketch)
    return sides.select(
        *keys,
        size("human").alias("n_human"),
        size("ai").alias("n_ai"),
        size(F.theta_union("human", "ai", log_size)).alias("n_both"),
        size(F.theta_intersection("human", "ai")).alias("n_shared"),
    )


def _tracked(terms: DataFrame, label: str, tracked: int) -> DataFrame:
    """``(class, sketch, total)`` of each class and of all: classes are sketched apart, their sketches combined for all."""
    name = F.when(F.col(label) == HUMAN, "HUMAN").when(F.col(label) == GENERATED, "AI").otherwise("OTHER")
    parts = terms.groupBy(name.alias("class")).agg(
        F.expr(f"approx_top_k_accumulate(term, {tracked})").alias("sketch"), F.count(F.lit(1)).alias("total")
    )
    named = parts.withColumn("class", F.explode(F.array(F.lit("ALL"), F.col("class")))).filter("class <> 'OTHER'")
    return named.groupBy("class").agg(F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch"), F.sum("total").alias("total"))


def _exact(terms: DataFrame, candidates: DataFrame, label: str) -> DataFrame:
    """``(class, term, n)`` of the candidates, counted over all occurrences; nothing else is shuffled."""
    own = candidates.select("term").distinct()
    counts = terms.join(own, "term", "left_semi").groupBy("term").agg(
        F.count(F.lit(1)).alias("ALL"),
        F.count_if(F.col(label) == HUMAN).alias("HUMAN"),
        F.count_if(F.col(label) == GENERATED).alias("AI"),
    )
    return counts.unpivot(["term"], ["ALL", "HUMAN", "AI"], "class", "n").filter("n > 0")


def frequent_terms(
    terms: DataFrame, n: int = 20, label: str = LABEL, tracked: int = 20_000, path: str | None = None
) -> DataFrame:
    """The ``n`` most frequent terms of each class and of all, ``(class, term, n, rank)``; the lower term wins a tie.

    ``terms`` has one row per occurrence with ``term`` and the label. A sketch of ``tracked`` counters proposes
    candidates; they are counted exactly in a second pass. A term that it does not hold occurs at most
    ``7 * total / tracked`` times, one that is held but not listed at most as often as the least estimate listed. So
    if the last of the ``n`` found occurs more often than both, or all terms are listed, the result is proved.
    Otherwise the sketch is widened fourfold, and beyond a million counters all terms are counted. Either way
    gives the same rows.

    What a sketch lists, its candidates and their counts are small and stored below ``path`` (by default a scratch
    folder): each is worked out once, and Spark knows the size of the candidates, so it can send them to the
    occurrences. Joined without a known size, all occurrences were shuffled.
    """
    path = path or scratch_dir(terms.sparkSession, "frequent")
    order = [F.desc("n"), F.asc("term")]
    while tracked <= MOST_TRACKED:
        sketches = _tracked(terms, label, tracked)
        most = min(tracked, max(16 * n, tracked // 16))
        listed = sketches.withColumn("items", F.expr(f"approx_top_k_estimate(sketch, {most})")).drop("sketch")
        listed = stored(listed, f"{path}/listed-{tracked}")
        candidates = stored(listed.select(F.explode("items.item").alias("term")).distinct(), f"{path}/candidates-{tracked}")
        counts = stored(_exact(terms, candidates, label), f"{path}/counts-{tracked}")
        top = top_n(counts, ["class"], order, n, "term")
        least = top.groupBy("class").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("found"))
        lost, full = F.col("total") * 7 / tracked, F.size("items") >= most
        unlisted = F.when(full, F.array_min("items.count")).otherwise(0)  # estimates are never below the count
        known = listed.join(least, "class", "left")
        proved = ((F.col("found") >= n) & (F.col("least") > F.greatest(lost, unlisted))) | ((lost < 1) & ~full)
        if not known.filter(~F.coalesce(proved, F.lit(False))).head(1):
            return top
        tracked *= 4
    return top_n(_exact(terms, terms, label), ["class"], order, n, "term")

"""Mixing sources to target weights by hash thresholds: histograms instead of a sort.

Every document has a hash of its id and text. A source that may give ``target`` words of its
``source_size`` gives each document ``floor(target / source_size)`` times, and once more where the
hash lies below the source's cut. The cut is found by histograms: words are summed by source and
leading hash bits, the bucket in which the budget ends is found, and only this bucket is summed
again by the next bits. Budgets nest: a larger one keeps all documents of a smaller one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.llm.text import count_words, packed, stored, unpacked

HASH_BITS, LEVEL_BITS, LEVELS = 60, 12, 2
RESULTS = ("size", "source_size", "target", "taken", "copies")


def _hash(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of id and text: the same in any engine and for any partitioning."""
    key = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``size`` (words) and ``_mix_hash``; columns named like results are replaced."""
    kept = docs.drop(*RESULTS, "_mix_hash")
    return kept.withColumns({"size": count_words(F.col(text)), "_mix_hash": _hash(F.col(doc_id), F.col(text))})


def source_targets(sizes: DataFrame, source: str, weights: tuple[int, ...], max_repeats: int) -> DataFrame:
    """One row per source: size, weight by rank (code points, null last), and target words.

    All words are shared by weight; no target exceeds ``max_repeats`` sizes, and what is over goes to
    the others by weight. That is one water level: sources in order of cap per weight, the first
    whose cap holds the level of all the later ones sets it. The windows see one row per source.
    """
    per_source = sizes.groupBy(F.col(source).alias("source")).agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(rank - 1, F.lit(len(weights))) + 1).cast("long")
    ranked = per_source.select("source", "source_size", rank.alias("rank"), weight.alias("weight"))
    capped = ranked.withColumn("cap", F.col("source_size") * max_repeats)
    up_to = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    onward = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(0, Window.unboundedFollowing)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = capped.withColumn(
        "level",
        (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(up_to), F.lit(0)))
        / F.sum("weight").over(onward),
    )
    own = F.col("cap") / F.col("weight")
    holds = F.min(F.when(F.col("level") <= own, F.struct(own, "rank", "level"))).over(everything)["level"]
    target = F.least(F.col("cap").cast("double"), holds * F.col("weight"))
    return levels.select("source", "source_size", target.alias("target"))


def _boundary(sums: DataFrame, budgets: DataFrame, by: str) -> DataFrame:
    """The first value of ``by`` at which a source's running words pass its budget, one row per source."""
    before = Window.partitionBy("source").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    running = sums.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0)))
    joined = running.alias("r").join(budgets.alias("b"), F.col("r.source").eqNullSafe(F.col("b.source")))
    past = joined.filter((F.col("before") <= F.col("budget")) & (F.col("before") + F.col("words") > F.col("budget")))
    return past.groupBy(F.col("r.source").alias("source")).agg(
        F.min(F.struct(by, "before", "words", "budget")).alias("at")
    )


def mix_plan(
    sizes: DataFrame, source: str = "source", weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3
) -> DataFrame:
    """One row per source: ``source_size``, ``target``, ``repeats`` (whole ones) and ``cut``.

    ``sizes`` holds ``size`` and ``_mix_hash`` of every document, a narrow stored table. Each level
    sums at most 4,096 buckets per source, partly in each task, so a hot source costs no more than
    any other. After two levels (24 bits) the boundary bucket is cut at single hashes.
    """
    targets = stored(source_targets(sizes, source, weights, max_repeats), "mix-targets")
    repeats = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    repeats = F.least(repeats, F.lit(max_repeats))
    plan = targets.withColumn("repeats", repeats.cast("long"))
    budgets = plan.select("source", (F.col("target") - F.col("repeats") * F.col("source_size")).alias("budget"))
    rows = sizes.select(F.col(source).alias("source"), "size", F.col("_mix_hash").alias("h"))
    for level in range(1, LEVELS + 1):
        bucket = F.shiftright("h", HASH_BITS - level * LEVEL_BITS)
        sums = rows.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words"))
        edge = stored(_boundary(sums, budgets, "bucket"), "mix-edge").select(
            "source", "at.bucket", (F.col("at.budget") - F.col("at.before")).alias("budget")
        )
        same = F.col("d.source").eqNullSafe(F.col("e.source")) & (bucket == F.col("e.bucket"))
        rows = rows.alias("d").join(edge.alias("e"), same, "left_semi")
        budgets = edge.select("source", "budget")
    last = _boundary(rows.groupBy("source", "h").agg(F.sum("size").alias("words")), budgets, "h")
    over = F.col("at.before") + F.col("at.words") - F.col("at.budget")
    nearest = F.when(over < F.col("at.budget") - F.col("at.before"), F.col("at.h") + 1).otherwise(F.col("at.h"))
    cuts = last.select(F.col("source").alias("cut_source"), nearest.alias("cut"))
    found = plan.join(cuts, F.col("source").eqNullSafe(F.col("cut_source")), "left").drop("cut_source")
    return stored(found.withColumn("cut", F.coalesce("cut", F.lit(0).cast("long"))), "mix-plan")


def apply_mix(measured_docs: DataFrame, plan: DataFrame, source: str = "source") -> DataFrame:
    """Measured documents with ``source_size``, ``target``, ``copies`` and ``taken`` = ``copies * size``."""
    chosen = plan.select(
        F.col("source").alias("_mix_source"), "source_size", "target", F.col("repeats").alias("_mix_repeats"),
        F.col("cut").alias("_mix_cut"),
    )
    joined = measured_docs.join(chosen, F.col(source).eqNullSafe(F.col("_mix_source")), "left")
    copies = F.col("_mix_repeats") + (F.col("_mix_hash") < F.col("_mix_cut")).cast("long")
    return (
        joined.withColumn("copies", copies)
        .withColumn("taken", F.col("copies") * F.col("size"))
        .drop("_mix_source", "_mix_repeats", "_mix_cut", "_mix_hash")
    )


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[int, ...] = (1, 2, 3),
    max_repeats: int = 3,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target``, ``taken`` and ``copies``.

    Null and blank texts have size 0. A null source is a source of its own, last in order. Rows equal
    in id and text share a hash and are taken or left together. A source of no words has target 0.
    Columns named like a result are replaced. An empty table gives an empty result.
    """
    rows = measured(packed(docs, *RESULTS, doc_id=doc_id, text=text, source=source))
    narrow = stored(rows.select("source", "size", "_mix_hash"), "mix-sizes")
    return unpacked(apply_mix(rows, mix_plan(narrow, "source", weights, max_repeats)), *RESULTS)


def mix_sizes(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_repeats: int = 3) -> DataFrame:
    """The same without the texts: they are read once, and the stored sizes serve plan and result."""
    narrow = stored(measured(docs).select("doc_id", "source", "size", "_mix_hash"), "mix-sizes")
    return apply_mix(narrow, mix_plan(narrow, "source", weights, max_repeats))

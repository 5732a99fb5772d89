"""Corpus report and exploration: several results from one stored table of counts or measures.

Everything a report needs is small next to the corpus. The large intermediate, term counts or
document measures, is written once below ``path`` and read back, so the texts are processed a
single time and a lost executor costs no more than a file read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.functions import ttr_columns
from quillmark.operators import corpus, summaries
from quillmark.operators.reshape import schema_table
from quillmark.operators.summaries import LABEL
from quillmark.profiles import ARABIC, LanguageProfile
from quillmark.sources.files import write_report
from quillmark.sources.scratch import stored


def corpus_report(
    df: DataFrame,
    path: str,
    profile: LanguageProfile = ARABIC,
    adjacency: str = "filtered",
    n: int = 20,
    distinctive: dict | None = None,
) -> dict[str, DataFrame]:
    """Statistics, top and distinctive terms of a processed corpus with ``category_encode``.

    Stores processed texts and classes below ``path``, as both counts and class sizes come from them, and
    the counts, by kind, so that a report on words skips the bigram files.
    """
    df = stored(df.select("processed_text", LABEL), f"{path}/corpus")
    terms = corpus.explode_terms(df, profile=profile, adjacency=adjacency, keep=(LABEL,))
    wide = stored(corpus.term_counts_wide(terms), f"{path}/counts", ("kind",))
    sizes = stored(summaries.class_distribution(df), f"{path}/class_sizes")
    long = corpus.counts_long(wide)
    stats = stored(corpus.lexical_stats(long), f"{path}/stats")
    return {
        "counts": long,
        "class_sizes": sizes,
        "stats": stats,
        "ratios": corpus.stat_ratios(stats),
        "inventory": corpus.type_inventory(long),
        "top_words": corpus.top_terms(long, corpus.WORD, n),
        "top_bigrams": corpus.top_terms(long, corpus.BIGRAM, n),
        "cloud": corpus.cloud_weights(long),
        "distinctive": corpus.distinctive_terms(wide, sizes, **(distinctive or {})),
    }


def explore(df: DataFrame, path: str) -> dict[str, DataFrame]:
    """Schema, class and subset distribution and type-token ratios of a processed corpus."""
    measured = ttr_columns(df).select(LABEL, "subset", "unique_tokens", "token_count", "doc_ttr")
    rows = stored(measured, f"{path}/measures")
    return {
        "schema": schema_table(df),
        "classes": summaries.class_share(rows),
        "subsets": summaries.subset_distribution(rows),
        "subset_classes": summaries.subset_class_pivot(rows),
        "ttr": summaries.ttr_by_class(rows),
        "ttr_histogram": summaries.ttr_histogram(rows),
    }


def write_reports(reports: dict[str, DataFrame], path: str, names: tuple[str, ...] | None = None) -> None:
    """Write result tables as JSON lines, one folder each."""
    for name in names or tuple(reports):
        write_report(reports[name].withColumn("report", F.lit(name)), f"{path}/{name}")

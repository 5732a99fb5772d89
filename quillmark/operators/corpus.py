"""Word and bigram statistics of a corpus, per class and combined.

Counts are kept wide, one row per term with one count per class, so that a single aggregation
keyed by the term serves every class and hot classes never form a group of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.functions.tokens import tokenize_script, tokenize_ws
from quillmark.operators.ranking import top_n
from quillmark.operators.reshape import GENERATED, HUMAN
from quillmark.operators.summaries import LABEL
from quillmark.profiles import ARABIC, LanguageProfile

WORD = "WORD"
BIGRAM = "BIGRAM"
CLASSES = ("ALL", "HUMAN", "AI")  # names of the classes in long tables
_WIDE = {"ALL": "n_all", "HUMAN": "n_human", "AI": "n_ai"}


def _terms(df: DataFrame, tokens: Column, sep: str, *keep: str, min_length: int = 1) -> DataFrame:
    """One row per occurrence: ``(*keep, kind, term)``, from one pass over the texts.

    Tokens are found once and laid beside their neighbours, so that no pattern runs over them again. Those under
    ``min_length`` characters are no words and part of no pair.
    """
    arrays = df.select(*keep, tokens.alias("_words"))
    shifted = arrays.withColumn("_nexts", F.slice("_words", F.lit(2), F.size("_words")))
    places = shifted.select(*keep, F.inline(F.arrays_zip("_words", "_nexts")).alias("_word", "_next"))
    long = lambda c: F.col(c) if min_length == 1 else F.when(F.length(c) >= min_length, F.col(c))
    word, pair = long("_word"), F.concat(long("_word"), F.lit(sep), long("_next"))
    kinds = F.stack(F.lit(2), F.lit(WORD), word, F.lit(BIGRAM), pair).alias("kind", "term")
    return places.select(*keep, kinds).filter("term IS NOT NULL")


def explode_terms(
    df: DataFrame,
    text: str = "processed_text",
    profile: LanguageProfile = ARABIC,
    adjacency: str = "filtered",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Occurrences of native-script words and of bigrams ``a_b``; ``adjacency`` as in :func:`script_bigrams`."""
    if adjacency == "filtered":
        return _terms(df, tokenize_script(text, profile, 2), "_", *keep)
    if adjacency == "original":
        return _terms(df, tokenize_script(text, profile), "_", *keep, min_length=2)
    raise ValueError(f"adjacency must be 'filtered' or 'original', not {adjacency!r}")


def explode_ws_terms(df: DataFrame, text: str = "processed_text", keep: tuple[str, ...] = ()) -> DataFrame:
    """Occurrences of white-space words and of bigrams ``a b``, paired before short words go."""
    return _terms(df, tokenize_ws(text), " ", *keep, min_length=2)


def term_counts(terms: DataFrame) -> DataFrame:
    """``(kind, term, n)`` from :func:`explode_terms`."""
    return terms.groupBy("kind", "term").agg(F.count(F.lit(1)).alias("n"))


def term_counts_wide(terms: DataFrame, label: str = LABEL) -> DataFrame:
    """``(kind, term, n_all, n_human, n_ai)``; an unknown class counts in ``n_all`` only."""
    return terms.groupBy("kind", "term").agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count_if(F.col(label) == HUMAN).alias("n_human"),
        F.count_if(F.col(label) == GENERATED).alias("n_ai"),
    )


def counts_long(wide: DataFrame) -> DataFrame:
    """``(kind, class, term, n)`` with the classes of :data:`CLASSES`, without zero counts."""
    pairs = ", ".join(f"'{name}', {column}" for name, column in _WIDE.items())
    return wide.selectExpr("kind", "term", f"stack(3, {pairs}) as (class, n)").filter("n > 0")


def term_counts_by_class(terms: DataFrame, label: str = LABEL) -> DataFrame:
    """``(kind, class, term, n)`` from occurrences that keep their label."""
    return counts_long(term_counts_wide(terms, label))


def typed_counts(counts: DataFrame) -> DataFrame:
    """Long counts as ``(type, key, count)``, with types such as ``WORD_HUMAN``."""
    return counts.select(F.concat_ws("_", "kind", "class").alias("type"), F.col("term").alias("key"), F.col("n").alias("count"))


def merge_counts(counts: DataFrame) -> DataFrame:
    """Sum pre-aggregated ``(type, key, count)`` rows."""
    return counts.groupBy("type", "key").agg(F.sum("count").alias("count"))


def lexical_stats(counts: DataFrame) -> DataFrame:
    """Tokens, types, ratios and bigram totals per class, from long counts.

    Hapax and dislegomena ratios are shares of the types.
    """
    word, pair = F.col("kind") == WORD, F.col("kind") == BIGRAM
    total = lambda of: F.coalesce(F.sum(F.when(of, F.col("n"))), F.lit(0))
    sums = counts.groupBy("class").agg(
        total(word).alias("total_tokens"),
        F.count_if(word).alias("unique_words"),
        F.count_if(word & (F.col("n") == 1)).alias("hapax_count"),
        F.count_if(word & (F.col("n") == 2)).alias("dislegomena_count"),
        total(pair).alias("total_bigrams"),
        F.count_if(pair).alias("unique_bigrams"),
    )
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return sums.withColumns(
        {
            "ttr_corpus": ratio("unique_words", "total_tokens"),
            "hapax_ratio": ratio("hapax_count", "unique_words"),
            "dislegomena_ratio": ratio("dislegomena_count", "unique_words"),
        }
    )


def top_terms(counts: DataFrame, kind: str, n: int = 20) -> DataFrame:
    """The ``n`` most frequent terms of each class; the lower term wins a tie."""
    of_kind = counts.filter(F.col("kind") == kind)
    return top_n(of_kind, ["class"], [F.desc("n"), F.asc("term")], n, "term")


def cloud_weights(counts: DataFrame, n: int = 200, min_length: int = 2) -> DataFrame:
    """Top words with their weight relative to the most frequent word of the class."""
    words = counts.filter((F.col("kind") == WORD) & (F.length("term") >= min_length))
    top = top_n(words, ["class"], [F.desc("n"), F.asc("term")], n, "term")
    return top.withColumn("weight", F.col("n") / F.max("n").over(Window.partitionBy("class")))


def type_inventory(counts: DataFrame) -> DataFrame:
    """Distinct terms and total occurrences per kind and class."""
    return counts.groupBy("kind", "class").agg(
        F.count(F.lit(1)).alias("distinct_terms"), F.sum("n").alias("occurrences")
    )


RATIO_STATS = (
    "total_tokens",
    "unique_words",
    "ttr_corpus",
    "hapax_ratio",
    "dislegomena_ratio",
    "total_bigrams",
    "unique_bigrams",
)


def stat_ratios(stats: DataFrame) -> DataFrame:
    """Each statistic for human and generated texts, and generated / human. One row per statistic."""
    values = ", ".join(f"'{c}', CAST({c} AS DOUBLE)" for c in RATIO_STATS)
    long = stats.selectExpr("class", f"stack({len(RATIO_STATS)}, {values}) as (stat, value)")
    of = lambda name: F.max(F.when(F.col("class") == name, F.col("value")))
    return (
        long.groupBy("stat")
        .agg(of("HUMAN").alias("human"), of("AI").alias("ai"))
        .withColumn("ai_to_human", F.try_divide("ai", "human"))
    )


def distinctive_terms(
    wide: DataFrame,
    class_sizes: DataFrame,
    kind: str = BIGRAM,
    candidates: int = 500,
    min_count: int = 100,
    n: int = 15,
    label: str = LABEL,
) -> DataFrame:
    """Terms most typical of generated texts.

    Among the ``candidates`` most frequent terms of the generated class with at least ``min_count``
    occurrences, the ``n`` with the highest ratio of occurrences per document; one is added to
    both human numbers. ``class_sizes`` has one row per class: label and ``n`` documents.
    """
    size = lambda value: F.coalesce(F.max(F.when(F.col(label) == value, F.col("n"))), F.lit(0))
    sizes = class_sizes.agg(F.struct(size(GENERATED).alias("ai"), size(HUMAN).alias("human"))).scalar()
    n_ai, n_human = sizes["ai"], sizes["human"]
    top = (
        wide.filter((F.col("kind") == kind) & (F.col("n_ai") > 0))
        .orderBy(F.desc("n_ai"), F.asc("term"))
        .limit(candidates)
        .filter(F.col("n_ai") >= min_count)
    )
    ratio = (F.col("n_ai") / n_ai) / ((F.col("n_human") + 1) / (n_human + 1))
    return top.select("term", "n_human", "n_ai", ratio.alias("ratio")).orderBy(F.desc("ratio"), F.asc("term")).limit(n)

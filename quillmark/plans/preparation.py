"""From raw tables to a processed corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.functions import clean_text, normalize_text, stylometry
from quillmark.operators.dedup import dedup_exact, subset_rank
from quillmark.operators.reshape import computed, drop_empty, drop_missing, encode_label, melt_texts, union_subsets
from quillmark.profiles import ARABIC, LanguageProfile
from quillmark.sources.files import SUBSETS, read_wide


def load_long(
    spark: SparkSession,
    directory: str,
    subsets: tuple[str, ...] = SUBSETS,
    suffix: str = "_abstract",
    human: str = "original_abstract",
) -> DataFrame:
    """The long table ``(category, text, subset, category_encode)`` of all subsets."""
    melted = (melt_texts(wide, suffix, ["subset"]) for wide in read_wide(spark, directory, subsets))
    return encode_label(union_subsets(list(melted)), human).select("category", "text", "subset", "category_encode")


def add_clean_texts(
    df: DataFrame, profile: LanguageProfile = ARABIC, text: str = "text", filtered: bool = False
) -> DataFrame:
    """Add ``cleaned_text`` and ``processed_text``; ``filtered`` if rows are to be filtered on the latter.

    A batch is dealt over the tasks first: a Parquet row group is never split, and cleaning takes far longer than a shuffle.
    """
    return _with_clean_texts(df if df.isStreaming else df.hint("rebalance"), profile, text, filtered)


def _with_clean_texts(df: DataFrame, profile: LanguageProfile, text: str = "text", filtered: bool = False) -> DataFrame:
    cleaned = df.withColumn("cleaned_text", clean_text(text))
    processed = normalize_text("cleaned_text", profile)
    if filtered:
        return computed(cleaned, "processed_text", processed)
    return cleaned.withColumn("processed_text", processed)


def preprocess(
    df: DataFrame, profile: LanguageProfile = ARABIC, subsets: tuple[str, ...] = SUBSETS, order: list | None = None
) -> DataFrame:
    """Drop rows without text, duplicates and texts with nothing left; add the cleaned texts.

    Of equal texts the one from the first subset listed stays.
    """
    order = order or [subset_rank("subset", list(subsets)), F.col("category")]
    kept = dedup_exact(drop_missing(df, ["text", "category"]), "text", order)
    return drop_empty(_with_clean_texts(kept, profile, filtered=True))


def add_style(df: DataFrame, profile: LanguageProfile = ARABIC, deal: bool = False) -> DataFrame:
    """Cleaned and processed texts and all style measures of a table with ``text``, batch or stream.

    ``deal`` deals a batch over the tasks first, as :func:`add_clean_texts` does.
    """
    add = add_clean_texts if deal else _with_clean_texts
    return stylometry(add(df, profile), profile=profile)



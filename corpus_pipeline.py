"""The corpus pipeline: filter, classify, remove near-duplicates, mix, encode.

Each stage is a function of ``(spark, docs, sf_dir)``. All but the last return the columns of
``documents``; what a stage returns is written as Parquet and read back as the next one's ``docs``.
Null and empty texts have too few words and go at the first stage. An empty table passes through all.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm import mixing, quality_rules, rule_ensemble, sentencepiece, simhash
from quillmark.llm.text import packed, stored, unpacked
from quillmark.operators.reshape import computed

PIECES = "/opt/tokenizers/piece_bpe_32k.model"  # a public vocabulary


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def _packed(docs: DataFrame) -> DataFrame:
    """What the operators read, beside all columns in one struct, which theirs cannot clash with."""
    return packed(docs, doc_id="doc_id", text="text", source="source")


def _kept(judged: DataFrame, verdict) -> DataFrame:
    """Rows of a true verdict, as they came. The verdict is worked out once, not again below."""
    return unpacked(computed(judged, "passed", verdict).filter("passed"))


def filter_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the word rules and the likelihood ratio."""
    return _kept(quality_rules.quality_rules(_packed(docs), _labels(spark, sf_dir)), F.col("kept"))


def filter_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble predicts to be of quality; it learns from the unfiltered table."""
    examples = spark.read.parquet(f"{sf_dir}/documents.parquet")
    judged = rule_ensemble.classify(_packed(docs), _labels(spark, sf_dir), examples=examples)
    return _kept(judged, F.col("predicted") == 1)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one of the smallest id.

    Fingerprints within two bits link, as in op6; so do texts whose five-word shingles have a Jaccard similarity of 0.8.
    """
    return simhash.near_dedup(docs, wide=True)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: sources at their target weights."""
    mixed = computed(mixing.mix(_packed(docs)), "times", F.col("copies")).filter(F.col("times") > 0)
    return unpacked(mixed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times")))))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether decoding them gives the text back."""
    pieces = sentencepiece.SentencePiece(spark, PIECES)
    rows = docs.withColumn("_coded", pieces.encode_checked("text"))
    n_tokens = F.coalesce(F.size("_coded.ids"), F.lit(0)).cast("long").alias("n_tokens")
    return rows.select("doc_id", "lang", "source", n_tokens, "_coded.ids", F.col("_coded.exact").alias("round_trip"))


STAGES = (
    ("quality_rules", filter_rules),
    ("quality_classifier", filter_quality),
    ("simhash_dedup", remove_near_duplicates),
    ("mixing", mix_sources),
    ("sentencepiece", encode),
)

#: The stages hash with XXH64, fit models and read a vocabulary, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

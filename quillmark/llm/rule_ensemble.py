"""Quality classifier: a sparse ensemble of rules over text statistics.

A small random forest is grown on statistics of labelled documents. Every path from a root to a node is
a rule, a conjunction of comparisons. A logistic regression with an L1 penalty on the rules keeps a few
of them, and these are compiled into one Spark column expression: scoring is a map without a shuffle,
a model object or Python.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.llm.text import NOT_BLANK, blank_words, packed, stored, unpacked

STATISTICS = (
    "log_words", "word_length", "long_words", "distinct_words", "repeated_neighbours", "symbols", "bars", "exclamations",
    "capitals", "digits", "stops", "line_words", "repeated_lines",
)


def with_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``_stats``, a struct of the statistics of the whole text; a null text counts as empty.

    Shares are per word or per character, 0 where there is none.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.withColumn("_words", blank_words(body))
    rows = rows.withColumn("_lines", F.filter(F.split(body, "\n"), lambda line: line.rlike(NOT_BLANK)))
    n, chars, lines = F.size("_words"), F.length(body), F.size("_lines")
    per = lambda x, y: F.when(y > 0, x / y).otherwise(0.0)
    without = lambda marks: chars - F.length(F.regexp_replace(body, f"[{marks}]", ""))
    neighbours = F.arrays_zip(F.col("_words").alias("a"), F.slice("_words", 2, F.greatest(n - 1, F.lit(0))).alias("b"))
    values = {
        "log_words": F.log1p(n),
        "word_length": per(F.length(F.array_join("_words", "")), n),
        "long_words": per(F.size(F.filter("_words", lambda w: F.length(w) > 20)), n),
        "distinct_words": per(F.size(F.array_distinct("_words")), n),
        "repeated_neighbours": per(F.size(F.filter(neighbours, lambda p: p["a"] == p["b"])), n),
        "symbols": per(without("#*$%&<>@=~^_"), chars),
        "bars": per(without("|"), chars),
        "exclamations": per(without("!"), chars),
        "capitals": per(without("A-Z"), chars),
        "digits": per(without("0-9"), chars),
        "stops": per(without(".?"), n),
        "line_words": per(n, lines),
        "repeated_lines": per(lines - F.size(F.array_distinct("_lines")), lines),
    }
    stats = F.struct(*(values[s].cast("double").alias(s) for s in STATISTICS))
    return rows.withColumn("_stats", stats).drop("_words", "_lines")


@dataclass(frozen=True)
class Rule:
    """A conjunction of ``(statistic, "<=" or ">", limit)``."""

    terms: tuple[tuple[str, str, float], ...]

    def column(self, stats: str = "_stats") -> Column:
        compared = [F.col(f"{stats}.{s}") <= v if op == "<=" else F.col(f"{stats}.{s}") > v for s, op, v in self.terms]
        return reduce(lambda a, b: a & b, compared)


@dataclass(frozen=True)
class RuleEnsemble:
    """Weighted rules and an intercept; ``score`` compiles them."""

    rules: tuple[tuple[Rule, float], ...]
    intercept: float

    def score(self, stats: str = "_stats") -> Column:
        """Probability of label 1."""
        margin = F.lit(self.intercept)
        for rule, weight in self.rules:
            margin = margin + F.when(rule.column(stats), weight).otherwise(0.0)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def _simple(terms) -> Rule:
    """At most one upper and one lower limit per statistic."""
    limits: dict[tuple[str, str], float] = {}
    for s, op, v in terms:
        old = limits.get((s, op))
        limits[s, op] = v if old is None else (min(old, v) if op == "<=" else max(old, v))
    return Rule(tuple((s, op, v) for (s, op), v in sorted(limits.items())))


def tree_rules(tree) -> list[Rule]:
    """All paths of a fitted tree, from the root to every node below it."""
    found = []

    def walk(node, terms):
        if terms:
            found.append(_simple(terms))
        if node.getClass().getSimpleName() == "InternalNode":
            split = node.split()
            name, limit = STATISTICS[split.featureIndex()], split.threshold()
            walk(node.leftChild(), [*terms, (name, "<=", limit)])
            walk(node.rightChild(), [*terms, (name, ">", limit)])

    walk(tree._java_obj.rootNode(), [])
    return found


def remainder(doc_id: Column, of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(of))


def training_rows(
    docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, folds: int, bound: int
) -> DataFrame:
    """``(label, stats)`` of at most ``bound`` labelled documents outside fold 0, those of the smallest hashes.

    The bound allows a broadcast of the labels; only these documents' texts are measured. Of several
    labels or rows of one id the smallest counts.
    """
    known = labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("double").alias("label"))
    known = known.filter(F.col("_id").isNotNull() & F.col("label").isin(0.0, 1.0) & (remainder(F.col("_id"), folds) != 0))
    known = known.groupBy("_id").agg(F.min("label").alias("label")).orderBy(F.xxhash64("_id"), "_id").limit(bound)
    texts = docs.select(F.col(doc_id).alias("_doc"), F.col(text).alias("_text"))
    joined = with_statistics(texts.join(F.broadcast(known), F.col("_doc") == F.col("_id")), "_text")
    return joined.groupBy("_id").agg(F.min(F.struct("label", "_stats")).alias("row")).select("_id", "row.*")


def fit_rules(rows: DataFrame, trees: int = 12, depth: int = 3, penalty: float = 0.002, seed: int = 7) -> RuleEnsemble:
    """Grow, extract, and weigh rules on a bounded table ``(_id, label, _stats)``.

    Where all labels are equal or none is known, there is no rule and the score is the smoothed share
    of label 1.
    """
    rows = rows.coalesce(1).sortWithinPartitions("_id")
    n, ones = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    if ones == 0 or ones == n:
        return RuleEnsemble((), math.log((ones + 1) / (n - ones + 1)))
    features = array_to_vector(F.array(*(F.col(f"_stats.{s}") for s in STATISTICS)))
    data = rows.select("label", "_stats", features.alias("features"))
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="0.5").fit(data)
    rules = sorted({r for tree in forest.trees for r in tree_rules(tree)}, key=lambda r: (len(r.terms), r.terms))
    if not rules:
        return RuleEnsemble((), math.log((ones + 1) / (n - ones + 1)))
    fired = array_to_vector(F.array(*(r.column().cast("double") for r in rules)))
    lasso = LogisticRegression(regParam=penalty, elasticNetParam=1.0, maxIter=100)
    model = lasso.fit(data.select("label", fired.alias("features")))
    kept = tuple((r, w) for r, w in zip(rules, model.coefficients.toArray().tolist()) if w)
    return RuleEnsemble(kept, float(model.intercept))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    folds: int = 5,
    bound: int = 20_000,
    threshold: float = 0.3,
    examples: DataFrame | None = None,
) -> DataFrame:
    """``docs`` with ``held_out``, ``score`` (0 to 1, higher: label 1 likelier) and ``predicted``.

    Fitted on at most ``bound`` labelled documents whose crc32 remainder modulo ``folds`` is not 0; the
    others are held out. ``examples`` are the documents to learn from, where ``docs`` are already filtered
    and most bad ones are gone. Only the text enters a score; null and empty texts are scored by the statistics
    of an empty text. A null id is held out. Equal texts get equal scores. Columns named like a result
    are replaced; an empty table gives an empty result, and without labels all scores are 0.5.
    """
    learnt_from = docs if examples is None else examples
    rows = stored(training_rows(learnt_from, labels, doc_id, text, label, folds, bound), "rule-training")
    ensemble = fit_rules(rows)
    rows = with_statistics(packed(docs, "held_out", "score", "predicted", doc_id=doc_id, text=text))
    scored = rows.withColumn("score", ensemble.score())
    held_out = (remainder(F.col("doc_id"), folds) == 0).alias("held_out")
    return unpacked(scored, "score", held_out, F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"))

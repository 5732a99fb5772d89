"""Katz backoff of any order as Spark tables: counts, probabilities and weights joined by n-gram.

A k-gram is the 64-bit hash of its k words, its history the hash of the first k-1, its shorter form that of
the last k-1; words before a text are starts, a text's last word is its end. With ``r`` the count of a k-gram,
``c(h)`` the sum of the counts after its history and ``d`` the discounts of Good-Turing for its order:

    p(w | h) = d(r) r / (c(h) + 1)        where the k-gram is known
             = a(h) p(w | h')             else; h' lacks the first word of h; a(h) = 1 for an unknown history
    a(h)     = (1 - sum p(w | h)) / (1 - sum p(w | h')), sums over the words known after h

and for single words ``p(w) = d(r) r / (N + 1)``, or what the known words leave. Every known k-gram's shorter
form is known, so the sums are plain joins and aggregations.

One aggregation with partial sums counts all orders; the table is partitioned by order. Probabilities and
weights are built from the shortest order up, texts are scored from the longest down: what an order does not
know takes its history's weight and goes on to the next. Events are distinct (text, n-gram) pairs with a
number of occurrences. Each side of a join is stored, so Spark splits the partition of a frequent n-gram or
history. Only counts of counts, ``K + 2`` an order, reach the driver.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.llm.katz import END, SCALE, START, K, discounts
from quillmark.llm.rule_ensemble import remainder
from quillmark.llm.text import blank_words, stored
from quillmark.operators.reshape import computed
from quillmark.sources.scratch import scratch_dir

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _fixed(logs: Column) -> Column:
    """Logarithms in fixed point: their sums are the same in any order."""
    return F.round(logs * SCALE).cast("long")


def _discount(n: Column, d: list[float]) -> Column:
    """Discounted counts, ``d(n) n``."""
    return n * F.when(n <= K, F.get(F.array(*(F.lit(float(x)) for x in d)), n.cast("int"))).otherwise(1.0)


def _tokens(text: Column, order: int) -> Column:
    """Hashes of the starts, the words and the end of a text."""
    name = lambda word: F.xxhash64(F.lit(word.decode()))
    words = F.transform(blank_words(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)), lambda w: F.xxhash64(w))
    return F.concat(F.array_repeat(name(START), order - 1), words, F.array(name(END)))


def events(rows: DataFrame, order: int) -> DataFrame:
    """``rid``, ``held_out`` and, of every token, its n-grams ``g1`` ... and the histories ``h2`` ... of these."""

    def at(i: Column) -> Column:
        gram = lambda last, k: F.xxhash64(*(F.get("tokens", last - j) for j in range(k - 1, -1, -1))) if k > 1 else F.get("tokens", last)
        grams = [gram(i, k).alias(f"g{k}") for k in range(1, order + 1)]
        return F.struct(*grams, *(gram(i - 1, k - 1).alias(f"h{k}") for k in range(2, order + 1)))

    split = computed(rows.select("rid", "held_out", "text"), "tokens", _tokens(F.col("text"), order))
    places = F.sequence(F.lit(order - 1), F.size("tokens") - 1)
    return split.select("rid", "held_out", F.explode(F.transform(places, at)).alias("at")).select("rid", "held_out", "at.*")


def count_ngrams(rows: DataFrame, order: int) -> DataFrame:
    """``(k, gram, past, shorter, n)`` of the training texts, for all orders up to ``order``, stored by ``k``."""
    none = F.lit(None).cast("long")
    kinds = [
        F.struct(
            F.lit(k).alias("k"), F.col(f"g{k}").alias("gram"),
            (F.col(f"h{k}") if k > 1 else none).alias("past"), (F.col(f"g{k - 1}") if k > 1 else none).alias("shorter"),
        )
        for k in range(1, order + 1)
    ]
    each = events(rows.filter(~F.col("held_out")), order).select(F.explode(F.array(*kinds)).alias("e")).select("e.*")
    sums = each.groupBy("k", "gram").agg(F.first("past").alias("past"), F.first("shorter").alias("shorter"), F.count(F.lit(1)).alias("n"))
    path = scratch_dir(rows.sparkSession, "ngram-counts")
    sums.write.partitionBy("k").parquet(path)
    return rows.sparkSession.read.schema(sums.schema).parquet(path)


class Backoff:
    """Tables of a model: ``probabilities[k]`` by n-gram, ``weights[k]`` by history, from :func:`count_ngrams`."""

    def __init__(self, counts: DataFrame, order: int):
        classes = counts.groupBy("k", F.least("n", F.lit(K + 2)).alias("r"))
        facts = classes.agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n")).collect()  # K + 2 rows an order
        of = lambda k: [sum(f["v"] for f in facts if (f["k"], f["r"]) == (k, r)) for r in range(K + 3)]
        self.order = order
        self.tokens = sum(f["n"] for f in facts if f["k"] == 1)
        self.words = sum(of(1))
        d = discounts(of(1))
        self.unknown = (sum((1 - d[r]) * r * of(1)[r] for r in range(1, K + 1)) + 1) / (self.tokens + 1)
        table = lambda k: counts.filter(F.col("k") == k)
        single = table(1).select("gram", "n", (_discount(F.col("n"), d) / (self.tokens + 1)).alias("p"))
        self.probabilities, self.weights = {1: stored(single, "ngram-p1")}, {}
        for k in range(2, order + 1):
            self._add(k, table(k), discounts(of(k)))

    def _add(self, k: int, table: DataFrame, d: list[float]) -> None:
        below = self.probabilities[k - 1].select(F.col("gram").alias("shorter"), F.col("p").alias("p_below"))
        kept = _discount(F.col("n"), d)
        sums = table.join(below, "shorter").groupBy("past").agg(
            F.sum("n").alias("total"), F.sum(F.col("n") - kept).alias("freed"), F.sum("p_below").alias("mass")
        )
        # The words known after a history leave at least one part in N + 1 below; less is rounding.
        left = F.greatest(1 - F.col("mass"), F.lit(1 / (self.tokens + 1)))
        weight = F.log10((F.col("freed") + 1) / (F.col("total") + 1) / left).alias("log_a")
        self.weights[k] = stored(sums.select("past", "total", weight), f"ngram-weights{k}")
        p = (kept / (F.col("total") + 1)).alias("p")
        self.probabilities[k] = stored(table.join(self.weights[k].select("past", "total"), "past").select("gram", p), f"ngram-p{k}")

    def logs(self, found: DataFrame) -> DataFrame:
        """``(rid, logs)``, to be summed by ``rid``, of events with ``times`` and the columns of :func:`events`."""
        done, left = [], found.withColumn("carried", F.lit(0).cast("long"))
        score = lambda p: (F.col("times") * (F.col("carried") + _fixed(F.log10(p)))).alias("logs")
        for k in range(self.order, 1, -1):
            known = self.probabilities[k].select(F.col("gram").alias(f"g{k}"), "p")
            tried = stored(left.join(known, f"g{k}", "left"), f"ngram-tried{k}")
            done.append(tried.filter("p IS NOT NULL").select("rid", score(F.col("p"))))
            weights = self.weights[k].select(F.col("past").alias(f"h{k}"), "log_a")
            open_ = tried.filter("p IS NULL").drop("p", f"g{k}").join(weights, f"h{k}", "left")
            carried = F.col("carried") + F.coalesce(_fixed(F.col("log_a")), F.lit(0))
            left = stored(open_.withColumn("carried", carried).drop("log_a", f"h{k}"), f"ngram-open{k}")
        known = self.probabilities[1].select(F.col("gram").alias("g1"), "p")
        done.append(left.join(known, "g1", "left").select("rid", score(F.coalesce("p", F.lit(self.unknown)))))
        return reduce(DataFrame.union, done)


def score_documents(docs: DataFrame, order: int = 3, doc_id: str = "doc_id", text: str = "text", folds: int = 10) -> DataFrame:
    """One row per row of ``docs``, with the columns of :func:`quillmark.llm.katz.score_documents`, at any order.

    Learns from the documents whose crc32 remainder modulo ``folds`` is not 0; a null id counts as empty text
    there. A null text counts as empty and has one token, its end. Repeated rows are scored, and learnt from, as
    often as they occur. Without training documents every token is unknown. Other columns are ignored; an empty
    table gives an empty result. An order below one is refused.
    """
    if order < 1:
        raise ValueError("a model has an order of one or more")
    held = (remainder(F.col(f"`{doc_id}`"), folds) == 0).alias("held_out")
    named = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), held, F.col(f"`{text}`").cast("string").alias("text"))
    rows = stored(named.withColumn("rid", F.monotonically_increasing_id()), "ngram-rows")
    model = Backoff(count_ngrams(rows, order), order)
    others = [f"g{k}" for k in range(1, order)] + [f"h{k}" for k in range(2, order + 1)]
    alike = events(rows, order).groupBy("rid", f"g{order}")
    found = stored(alike.agg(F.count(F.lit(1)).alias("times"), *(F.first(c).alias(c) for c in others)), "ngram-events")
    words = found.groupBy("rid", "g1").agg(F.sum("times").alias("times"))
    words = stored(words, "ngram-words").join(model.probabilities[1].select(F.col("gram").alias("g1"), "n"), "g1", "left")
    zero = F.lit(0).cast("long")
    base = F.col("times") * _fixed(F.log10(F.coalesce("n", zero) + 0.1))
    seen = F.when(F.col("n").isNotNull(), F.col("times")).otherwise(zero)
    counted = words.select("rid", zero.alias("logs"), base.alias("base"), seen.alias("known"), "times")
    scored = model.logs(found).select("rid", "logs", zero.alias("base"), zero.alias("known"), zero.alias("times"))
    sums = counted.union(scored).groupBy("rid").agg(*(F.sum(c).alias(c) for c in ("logs", "base", "known", "times")))
    base_score = F.col("base") / SCALE - F.col("times") * F.log10(F.lit(model.tokens + 0.1 * (model.words + 1)))
    return rows.drop("text").join(stored(sums, "ngram-sums"), "rid").select(
        "doc_id", "held_out", F.col("times").alias("n_tokens"), F.col("known").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), base_score.alias("base_score"), (F.col("logs") / SCALE).alias("score"),
    )

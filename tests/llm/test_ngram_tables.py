"""Katz scores of orders one to three against a plain model, its normalisation, and rows as partitions grow."""

import math
import zlib
from collections import Counter

import llm_cases as cases
import numpy as np
import pytest

from quillmark.llm import katz
from quillmark.llm import ngram_tables as q
from quillmark.llm.text import stored


class Plain:
    """The model of the module's docstring with dictionaries."""

    def __init__(self, texts, order):
        self.order, self.n = order, sum(map(len, texts))
        self.counts = [Counter() for _ in range(order + 1)]
        for words in texts:
            padded = ["<start>"] * (order - 1) + words
            for i in range(order - 1, len(padded)):
                for k in range(1, order + 1):
                    self.counts[k][tuple(padded[i - k + 1 : i + 1])] += 1
        classes = lambda c: [0, *(sum(1 for x in c.values() if x == r) for r in range(1, q.K + 2)), 0]
        self.d = [None, *(katz.discounts(classes(c)) for c in self.counts[1:])]
        self.after = [{} for _ in range(order + 1)]
        for k in range(1, order + 1):
            for gram, r in self.counts[k].items():
                self.after[k].setdefault(gram[:-1], {})[gram[-1]] = r
        self.unknown = 1 - sum(self.known(1, (), w) for w in self.after[1].get((), {}))

    def known(self, k, h, w):
        followers = self.after[k][h]
        r = followers[w]
        return (self.d[k][r] if r <= q.K else 1.0) * r / (sum(followers.values()) + 1)

    def probability(self, h, w, k=None):
        k = k or self.order
        h = tuple(h)[len(h) - k + 1 :]
        followers = self.after[k].get(h, {})
        if w in followers:
            return self.known(k, h, w)
        if k == 1:
            return self.unknown
        weight = 1.0
        if followers:
            left = 1 - sum(self.known(k, h, v) for v in followers)
            weight = left / (1 - sum(self.probability(h, v, k - 1) for v in followers))
        return weight * self.probability(h, w, k - 1)


MADE = [
    (i, " ".join(f"w{int(x)}" for x in np.random.default_rng(i).zipf(1.5, 40) % 30), "en", "s", 0) for i in range(20, 120)
]


def tokens(text):
    return [*cases.words(cases.lowered(text)), "<end>"]


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_a_plain_model(spark, order):
    short = [r if len(r[1] or "") < 100_000 else (*r[:1], r[1][:3000], *r[2:]) for r in cases.ROWS]
    rows = [*short, *MADE, *((i, "again " * 300, "en", "s", 0) for i in range(200, 260))]  # a pair of a large share
    model = Plain([tokens(r[1]) for r in rows if not held(r[0])], order)
    wanted = []
    for doc_id, text, *_ in rows:
        padded = ["<start>"] * (order - 1) + tokens(text)
        score = sum(math.log10(model.probability(padded[i - order + 1 : i], padded[i])) for i in range(order - 1, len(padded)))
        count = lambda w: model.counts[1][(w,)]
        base = sum(math.log10((count(w) + 0.1) / (model.n + 0.1 * (len(model.counts[1]) + 1))) for w in tokens(text))
        wanted.append((str(doc_id), held(doc_id), len(tokens(text)), sum(count(w) > 0 for w in tokens(text)), model.n, base, score))
    got = sorted(q.score_documents(cases.documents(spark, rows), order).collect(), key=lambda r: (str(r[0]), r[2]))
    assert len(got) == len(wanted)
    for a, b in zip(got, sorted(wanted, key=lambda r: (r[0], r[2]))):
        assert (str(a[0]), *a[1:5]) == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-6)
    everything = [w for (w,) in model.counts[1]] + [None]
    for h in (["<start>"] * 2, ["w1", "w2"], ["again", "again"], ["nowhere", "w1"]):
        assert sum(model.probability(h, w) for w in everything) == pytest.approx(1, abs=1e-9)


def test_order_two_equals_the_packed_operator(spark):
    docs = cases.documents(spark, [*cases.ROWS, *MADE])
    rows = lambda df: sorted(((str(r[0]), *r[1:]) for r in df.collect()), key=lambda r: (r[0], r[2]))
    for a, b in zip(rows(q.score_documents(docs, 2)), rows(katz.score_documents(docs)), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-6)


def test_tables_do_not_grow_with_partitions(spark):
    docs = cases.documents(spark, MADE)

    def written(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        named = docs.selectExpr("doc_id rid", "false held_out", "text")
        counts = q.count_ngrams(stored(named, "t"), 2)
        model = q.Backoff(counts, 2)
        return [t.count() for t in (counts, *model.probabilities.values(), *model.weights.values())]

    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert written("4") == written("16")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_all_held_out_and_empty(spark):
    ids = [i for i in range(200) if held(i)][:3]
    got = q.score_documents(cases.documents(spark, [(i, "some words", "en", "s", 0) for i in ids])).collect()
    assert {(r["n_known"], r["train_tokens"], r["held_out"], r["n_tokens"]) for r in got} == {(0, 0, True, 3)}
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in got)
    assert q.score_documents(cases.empty(spark)).collect() == []
    with pytest.raises(ValueError):
        q.score_documents(cases.empty(spark), 0)

"""Katz scores against a plain model, and its normalisation."""

import math
import zlib
from collections import Counter

import llm_cases as cases
import numpy as np
import pytest

from quillmark.llm import katz as q


class Plain:
    """The model of the module's docstring with dictionaries."""

    def __init__(self, texts):
        self.c, self.r, self.h = Counter(), Counter(), Counter()
        for words in texts:
            past = ["<start>", *words[:-1]]
            self.c.update(words)
            self.r.update(zip(past, words))
            self.h.update(past)
        self.n = sum(self.c.values())
        self.d1, self.d2 = (q.discounts(self._classes(x)) for x in (self.c, self.r))
        self.p1 = {w: self._d(self.d1, c) * c / (self.n + 1) for w, c in self.c.items()}
        self.unknown = 1 - sum(self.p1.values())
        self.after = {}
        for h, w in self.r:
            self.after.setdefault(h, []).append(w)

    @staticmethod
    def _classes(counts):
        return [0, *(sum(1 for x in counts.values() if x == r) for r in range(1, q.K + 2)), 0]

    @staticmethod
    def _d(d, count):
        return d[count] if count <= q.K else 1.0

    def pair(self, h, w):
        return self._d(self.d2, self.r[h, w]) * self.r[h, w] / (self.h[h] + 1)

    def weight(self, h):
        known = self.after.get(h)
        if not known:
            return 1.0
        return (1 - sum(self.pair(h, w) for w in known)) / (1 - sum(self.p1[w] for w in known))

    def probability(self, h, w):
        return self.pair(h, w) if self.r[h, w] else self.weight(h) * self.p1.get(w, self.unknown)


def _compare(spark, rows):
    got = q.score_documents(cases.documents(spark, rows)).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    tokens = lambda t: [*cases.words(cases.lowered(t)), "<end>"]
    model = Plain([tokens(r[1]) for r in rows if not held(r[0])])
    wanted = []
    for doc_id, text, *_ in rows:
        words = tokens(text)
        base = sum(math.log10((model.c[w] + 0.1) / (model.n + 0.1 * (len(model.c) + 1))) for w in words)
        score = sum(math.log10(model.probability(h, w)) for h, w in zip(["<start>", *words], words))
        wanted.append((str(doc_id), held(doc_id), len(words), sum(model.c[w] > 0 for w in words), model.n, base, score))
    assert len(got) == len(wanted)
    for a, b in zip(sorted(got, key=lambda r: (str(r[0]), r[2])), sorted(wanted, key=lambda r: (r[0], r[2]))):
        assert (str(a[0]), *a[1:5]) == b[:5]
        assert a[5:] == pytest.approx(b[5:], rel=1e-6)
    return model


def test_scores_equal_a_plain_model(spark):
    rng = np.random.default_rng(5)
    made = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.5, 60) % 300), "en", "s", 0) for i in range(20, 200)]
    model = _compare(spark, [*cases.ROWS, *made])
    everything = [*model.p1, None]
    for h in ["<start>", "w1", "w2", "nowhere", "the"]:
        assert sum(model.probability(h, w) for w in everything) == pytest.approx(1, abs=1e-9)


def test_frequent_words_and_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(q, "PARTITIONS", 7)
    rows = [(i, "the " * (i % 5) + f"x{i % 9} the y{i % 4} the", "en", "s", 0) for i in range(80)]
    _compare(spark, rows)


def test_all_held_out_and_empty(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    got = q.score_documents(cases.documents(spark, [(i, "some words", "en", "s", 0) for i in held])).collect()
    assert {(r["n_known"], r["train_tokens"], r["held_out"]) for r in got} == {(0, 0, True)}
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in got)
    assert q.score_documents(cases.empty(spark)).collect() == []


def test_packing_is_exact():
    rng = np.random.default_rng(1)
    columns = {
        "a": np.sort(rng.integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2)),
        "b": rng.integers(-5, 9, 77).astype(np.int32), "c": rng.normal(size=3).astype(np.float32), "d": np.zeros(0, np.int64),
    }
    back = q.unpack(q.pack(columns))
    assert all(np.array_equal(back[k], v) and back[k].dtype == v.dtype for k, v in columns.items())


def test_discounts():
    good = q.discounts([0, 1000, 400, 220, 140, 95, 70, 0])
    assert all(0 < d <= 1 for d in good) and good[1] < good[2] < good[3]
    assert all(0 < d <= 1 for d in q.discounts([0] * 8)) and all(0 < d <= 1 for d in q.discounts([0, 5, 0, 9, 0, 0, 0, 0]))

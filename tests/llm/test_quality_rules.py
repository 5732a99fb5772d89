"""Quality rules against plain Python."""

import math
from collections import Counter

import llm_cases as cases
import xxhash
from pyspark.sql import functions as F

from quillmark.llm import quality_rules as q

BUCKETS = 1 << 10


def _signed(n):
    return n - (1 << 64) if n >> 63 else n


def _xx_long(value, seed):
    """Spark's hash of one long with a seed: XXH64 of its eight bytes."""
    return xxhash.xxh64_intdigest(value.to_bytes(8, "little"), seed)


def _buckets(words):
    hashes = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    pairs = [_xx_long(b, _xx_long(a, 42)) for a, b in zip(hashes, hashes[1:])]
    return [h & (BUCKETS - 1) for h in hashes + pairs]


def _measures(text):
    words = cases.words(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if counts[w] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if cases.words(x)]
    n, symbols = len(words), sum(c in "#*$%&|<>" for c in text or "")
    failed = n < 10 or 100 * len(covered) > 20 * n
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


def test_measures_and_scores_equal_plain_python(spark):
    docs, labels = cases.documents(spark), cases.labels(spark)
    got = q.quality_rules(docs, labels, n_buckets=BUCKETS).collect()
    assert len(got) == len(cases.ROWS)
    trusted = {1, 2, 7}
    raw, target = Counter(), Counter()
    for doc_id, text, *_ in cases.ROWS:
        grams = _buckets(cases.words(text))
        raw.update(grams)
        if doc_id in trusted:
            target.update(grams)
    all_raw, all_target = sum(raw.values()), sum(target.values())
    ratio = lambda b: math.log((target[b] + 1) / (all_target + BUCKETS)) - math.log((raw[b] + 1) / (all_raw + BUCKETS))
    for row in got:
        assert tuple(row[m] for m in q.MEASURES) == _measures(row["text"])
        grams = _buckets(cases.words(row["text"]))
        score = sum(map(ratio, grams)) / max(1, len(grams))
        assert abs(row["score"] - score) < 1e-5
        assert row["kept"] == (not row["base_failed"] and row["score"] >= -0.3)
        assert row["size"] == "mine"


def test_without_trusted_documents_scores_are_zero(spark):
    none = cases.labels(spark).filter("quality = 7")
    assert {r["score"] for r in q.quality_rules(cases.documents(spark), none, n_buckets=BUCKETS).collect()} == {0.0}


def test_empty_table(spark):
    assert q.quality_rules(cases.empty(spark), cases.labels(spark), n_buckets=BUCKETS).collect() == []


def test_plan_is_native_and_scores_without_a_shuffle(spark, sf_dir):
    import __spark_entry__ as entry

    text = entry.queries()["op1_quality_rules"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Exchange" not in text and "NestedLoop" not in text


def test_junk_goes_and_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    judged = q.quality_rules(docs.select("doc_id", "text"), labels).filter("NOT base_failed").join(labels, "doc_id")
    share = {r[0]: r[1] for r in judged.selectExpr("quality", "CAST(kept AS INT) AS k").groupBy("quality").avg("k").collect()}
    assert share[1] > 0.99 and share[0] < 0.1


def test_every_trusted_document_is_counted(spark):
    n = 25_000
    docs = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"))
    labels = spark.range(0, n, 1, 3).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    trusted = q.trusted_ids(labels.union(labels.limit(5)))
    assert trusted.count() == n
    counts = q.count_buckets(docs, trusted)
    assert tuple(counts.agg(F.sum("raw"), F.sum("target")).first()) == (3 * n, 3 * n)
    assert "Broadcast" not in counts._jdf.queryExecution().executedPlan().toString()


def test_windows_are_made_only_where_pairs_repeat(spark):
    """Overlapping and distant repeats, and texts just short of a repeated window."""
    five, four = "p q r s t", "p q r s"
    texts = ["a a a a a a", "a a a a a", f"{five} x {five}", f"{four} x {four} y", f"{four} {four} {four}", "a b a b a b a b", "a\n\na\n a"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = q.with_measures(q.with_hashes(df)).select("text", *q.MEASURES).collect()
    assert {r["text"]: tuple(r[m] for m in q.MEASURES) for r in got} == {t: _measures(t) for t in texts}

"""The pipeline: columns, decisions, edges."""

import corpus_pipeline as p
import llm_cases as cases
from pyspark.sql import functions as F

from quillmark.llm import mixing, quality_rules, rule_ensemble, simhash
from quillmark.llm.text import stored


def test_stages_keep_columns_and_take_effect(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, labels = docs.columns, spark.read.parquet(f"{sf}/labels.parquet")
    ids = lambda df: sorted(r[0] for r in df.select("doc_id").collect())
    for name, stage in p.STAGES:
        before, out = docs, stored(stage(spark, docs, sf), "t")
        if name == "quality_rules":
            assert ids(out) == ids(quality_rules.quality_rules(before, labels).filter("kept"))
            assert len(ids(out)) < before.count()
        elif name == "quality_classifier":
            judged = rule_ensemble.classify(before, labels, examples=spark.read.parquet(f"{sf}/documents.parquet"))
            assert ids(out) == ids(judged.filter("predicted = 1"))
        elif name == "simhash_dedup":
            assert ids(out) == brute_force_survivors(before.select("doc_id", "text").collect())
        elif name == "mixing":
            mixed = mixing.mix_sizes(before).filter("taken > 0").select("doc_id", F.expr("taken div size").alias("n"))
            assert ids(out) == sorted(r["doc_id"] for r in mixed.collect() for _ in range(r["n"]))
        else:
            assert out.count() == before.count() and out.filter("NOT round_trip").count() == 0
            assert out.filter(F.size("ids") != F.col("n_tokens")).count() == 0
            break
        assert out.columns == columns
        docs = out


def test_run_is_repeatable(spark):
    rows = lambda: sorted((r["doc_id"], r["n_tokens"]) for r in p.run(spark, "/root/testdata/sf0.001").collect())
    first = rows()
    assert first and first == rows()


def test_odd_and_empty_tables_pass_through(spark):
    sf = "/root/testdata/sf0.001"
    for docs in (cases.documents(spark), cases.empty(spark)):
        for name, stage in p.STAGES:
            docs = stored(stage(spark, docs, sf), "t")
        assert docs.columns[-1] == "round_trip"


def brute_force_survivors(rows):
    """The smallest id of each group that two bits or a five-word Jaccard similarity of 0.8 link, all pairs compared."""
    words = [cases.lowered(r["text"]).split() for r in rows]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in words]
    prints = [simhash.fingerprint_of((r["text"] or "").encode()) for r in rows]
    least = {i: i for i in range(len(rows))}

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            small, large = sorted((len(sets[i]), len(sets[j])))
            alike = 5 * small >= 4 * large > 0 and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
            if alike or (prints[i] ^ prints[j]).bit_count() <= 2:
                least[max(root(i), root(j))] = min(root(i), root(j))
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(root(i), []).append(r["doc_id"])
    return sorted(min(g) for g in groups.values())


def test_near_copies_go_though_their_fingerprints_lie_apart(spark):
    words = [f"w{i * i % 9973}" for i in range(200)]
    texts = [" ".join(words[:at] + ["other"] + words[at + 1 :]) for at in (20, 60, 100, 140)]
    prints = [simhash.fingerprint_of(t.encode()) for t in texts]
    assert max((a ^ b).bit_count() for a in prints for b in prints) > 2
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate(texts)], cases.SCHEMA)
    assert [r["doc_id"] for r in p.remove_near_duplicates(spark, docs, "").collect()] == [0]


HELPERS = (
    "score kept size target source_size taken copies n_words base_failed held_out predicted passed times copy _times _copy _row _row_hash row_hash "
    "_words _hw _stats _grams _ratios _lines _mix_hash _mix_source _url_note fp tid key kept_id kept_hash root component_id"
).split()


def test_every_column_of_the_caller_comes_back_unchanged(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(120)
    mine = lambda c: F.concat(F.lit(f"{c}-"), F.col("doc_id").cast("string"))
    docs = stored(docs.select("*", *(mine(c).alias(c) for c in HELPERS)), "t")
    columns = docs.columns
    for name, stage in p.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf), "t")
        assert docs.columns == columns and docs.count()
        wrong = [F.max(F.col(f"`{c}`") != mine(c)).alias(c) for c in HELPERS]
        assert not any(docs.agg(*wrong).first()), name


def test_mixing_runs_no_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = p.mix_sources(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan

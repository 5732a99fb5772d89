"""Sketches against exact results; counts in bucketed tables."""

import pytest
from pyspark.sql import functions as F

from quillmark.operators import corpus, ranking, sketches
from quillmark.sources import count_store
from quillmark.sources.scratch import scratch_dir, stored


@pytest.fixture(scope="module")
def values(spark):
    rows = spark.range(60_000).selectExpr(
        "id % 4 AS part", "CAST(id % 2 AS int) AS label", "CASE WHEN id % 11 = 0 THEN NULL ELSE pmod(xxhash64(id), 10000) END AS x",
        "CAST(pmod(xxhash64(id, 1), 7) AS double) AS y",
    )
    return stored(rows, scratch_dir(spark, "values"))


def test_merged_quantiles_stay_within_the_rank_error(values):
    made = sketches.quantile_sketches(values, ["part", "label"], ["x", "y"])
    assert made.columns == ["part", "label", "feature", "sketch"] and made.count() == 16 // 2
    found = sketches.merged_quantiles(made, ["label"], (0.1, 0.5, 0.9)).collect()
    assert len(found) == 2 * 2 * 3
    for r in found:
        mine = values.filter((F.col("label") == r["label"]) & F.col(r["feature"]).isNotNull())
        below, up_to = mine.agg(F.avg((F.col(r["feature"]) < r["value"]).cast("int")), F.avg((F.col(r["feature"]) <= r["value"]).cast("int"))).first()
        assert below - 3 * sketches.RANK_ERROR <= r["prob"] <= up_to + 3 * sketches.RANK_ERROR


def test_quantiles_of_nulls_and_empty_tables(values):
    nulls = values.withColumn("x", F.lit(None).cast("double"))
    assert sketches.merged_quantiles(sketches.quantile_sketches(nulls, ["label"], ["x"]), ["label"]).count() == 0
    assert sketches.merged_quantiles(sketches.quantile_sketches(values.limit(0), ["label"], ["x"]), ["label"]).count() == 0


def test_no_exchange_holds_the_values(values):
    made = sketches.quantile_sketches(values, ["label"], ["x", "y"])
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_kll_sketch_agg_double" in plan


def terms_of(spark, rows):
    return spark.createDataFrame(rows, "term string, category_encode int")


def test_types_of_classes_and_shared(spark):
    rows = [(f"t{i}", 1) for i in range(3000)] + [(f"t{i}", 0) for i in range(2000, 9000)] + [("u", None), (None, 1)]
    made = sketches.type_sketches(terms_of(spark, rows).withColumn("part", F.col("category_encode") % 2), ["part", "category_encode"])
    row = sketches.class_types(made, []).first()
    for name, wanted in (("n_human", 3000), ("n_ai", 7000), ("n_both", 9000), ("n_shared", 1000)):
        assert abs(row[name] - wanted) <= 0.05 * 9000
    only = sketches.class_types(sketches.type_sketches(terms_of(spark, [("a", 1)]), ["category_encode"]), []).first()
    assert (only["n_human"], only["n_ai"], only["n_both"], only["n_shared"]) == (1, 0, 1, 0)


def exact_top(terms, n):
    wide = corpus.term_counts_wide(terms.withColumn("kind", F.lit("WORD")))
    rows = corpus.top_terms(corpus.counts_long(wide), "WORD", n).select("class", "term", "n", "rank")
    return sorted(map(tuple, rows.collect()))


def test_frequent_terms_equal_full_counts_also_after_widening(spark, monkeypatch):
    # A long tail, ties at the end of the list, a class of few terms, terms without a class.
    tail = spark.range(20_000).selectExpr("concat('t', id) AS term", "CAST(id % 2 AS int) AS category_encode")
    hot = spark.range(30_000).selectExpr("concat('h', CAST(pow(id % 900, 0.5) AS int)) AS term", "CASE id % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS category_encode")
    terms = stored(tail.union(hot), scratch_dir(spark, "terms"))
    tried = []
    real = sketches._tracked
    monkeypatch.setattr(sketches, "_tracked", lambda t, label, m: tried.append(m) or real(t, label, m))
    found = sketches.frequent_terms(terms, 5, tracked=2_000).select("class", "term", "n", "rank")
    assert sorted(map(tuple, found.collect())) == exact_top(terms, 5)
    assert tried[0] == 2_000
    tried.clear()
    flat = sketches.frequent_terms(tail, 5, tracked=500).select("class", "term", "n", "rank")  # nothing is frequent: proof fails
    assert sorted(map(tuple, flat.collect())) == exact_top(tail, 5)
    assert len(tried) > 3 and tried[1] == 4 * tried[0]
    assert sketches.frequent_terms(terms.limit(0), 5).count() == 0


def test_the_second_pass_shuffles_candidates_only(spark):
    terms = terms_of(spark, [("a", 1), ("b", 0)])
    plan = sketches._exact(terms, terms.limit(1), "category_encode")._jdf.queryExecution().optimizedPlan().toString()
    before = plan.index("LeftSemi")
    assert plan.index("Aggregate") < before  # the semi join lies below the count


def test_merging_stored_counts_needs_no_exchange(spark):
    rows = lambda a, b: spark.createDataFrame([("WORD_ALL", f"w{i}", i + 1) for i in range(a, b)] + [("WORD_ALL", "w5", 7)] * 2, "type string, key string, count long")
    root = scratch_dir(spark, "counts")
    parts = [rows(0, 300), rows(200, 500), rows(0, 10)]
    names = [f"t{i}_{root[-32:]}" for i in range(len(parts))]
    for name, part in zip(names, parts):
        count_store.save_counts(part, name, buckets=4, path=f"{root}/{name}")
    merged = count_store.merge_stored(spark, names, 4, f"{root}/merged")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in count_store.add_stored(spark, *names[:2])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    wanted = corpus.merge_counts(parts[0].union(parts[1]).union(parts[2]))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, wanted.collect()))
    with pytest.raises(ValueError):
        count_store.merge_stored(spark, [])


def test_occurrences_are_not_shuffled_to_meet_candidates(spark, monkeypatch):
    """Stored candidates have a known size, so Spark sends them to the occurrences."""
    plans, real = [], sketches._exact
    spy = lambda terms, candidates, label: (plans.append(real(terms, candidates, label)), plans[-1])[1]
    monkeypatch.setattr(sketches, "_exact", spy)
    rows = spark.range(50_000).selectExpr("concat('h', CAST(pow(id % 900, 0.5) AS int)) AS term", "CAST(id % 2 AS int) AS category_encode")
    terms = stored(rows, scratch_dir(spark, "terms"))
    assert sketches.frequent_terms(terms, 5).count() == 15
    (plan,) = (p._jdf.queryExecution().executedPlan().toString() for p in plans)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_bigrams_are_found_without_storing_their_occurrences(spark, sf_dir, monkeypatch):
    from checks import corpus_queries

    kept, real = [], corpus_queries.stored
    monkeypatch.setattr(corpus_queries, "stored", lambda df, path: (kept.append(df.columns), real(df, path))[1])
    corpus_queries.frequent_bigrams(spark, sf_dir)
    assert kept == [["processed_text", "category_encode"]]

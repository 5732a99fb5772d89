"""End-to-end reports from stored counts."""

from checks import tables
from quillmark.plans import reports
from quillmark.sources.scratch import scratch_dir


def test_corpus_report(spark, sf_dir):
    root = scratch_dir(spark, "report")
    made = reports.corpus_report(tables.processed(spark, sf_dir), root, distinctive={"min_count": 2})
    reports.write_reports(made, f"{root}/json", ("stats", "ratios", "top_words", "top_bigrams", "distinctive", "cloud", "inventory"))
    back = spark.read.json(f"{root}/json/stats")
    assert {r["class"] for r in back.collect()} == {"ALL", "HUMAN", "AI"}
    assert spark.read.json(f"{root}/json/top_words").count() == 60
    words_only = made["top_words"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in words_only and "WORD" in words_only


def test_explore(spark, sf_dir):
    made = reports.explore(tables.processed(spark, sf_dir), scratch_dir(spark, "explore"))
    total = sum(r["n"] for r in made["ttr_histogram"].collect())
    assert total == made["ttr"].groupBy().sum("n_docs").first()[0]
    assert made["schema"].count() == len(tables.processed(spark, sf_dir).columns)
    assert sum(r["percent"] for r in made["classes"].collect()) > 99.99

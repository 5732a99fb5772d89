"""What the plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from checks import tables
from quillmark.operators import corpus, evaluation, tfidf
from quillmark.operators.ranking import quantiles_by_group
from quillmark.operators.splits import exact_split
from quillmark.operators.summaries import ttr_histogram
from quillmark.functions import tokenize_ws, ttr_columns
from quillmark.functions import cleaning
from quillmark.plans.preparation import add_clean_texts, add_style, preprocess
from quillmark.profiles import LATIN

CLEANING = "(?:http|www)"  # part of one cleaning pattern: its count is the number of cleaning passes

OF_TWO = ("op", "pipeline")  # the subpackage checks its own plans
PLAIN = [n for n in entry.queries() if not n.startswith(OF_TWO)]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("\n+- == Initial Plan ==")[0]


@pytest.mark.parametrize("name", PLAIN)
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    text = plan(entry.queries()[name](spark, sf_dir))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroups", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert node not in text


def test_columns_and_filters_reach_the_scan(spark, sf_dir):
    text = plan(entry.queries()["filter_class"](spark, sf_dir))
    assert "PushedFilters: [IsNotNull(quality), EqualTo(quality,1)]" in text
    assert "ReadSchema: struct<doc_id:bigint,quality:int>" in text
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan(entry.queries()["scan_project"](spark, sf_dir))


def test_style_is_generated_code_and_cleans_once(spark, sf_dir):
    df = add_style(tables.table(spark, sf_dir, "documents"), LATIN).select("doc_id", "redundancy_score", "total_words", "total_sentences")
    text = final_plan(df)
    assert text.count(CLEANING) == 1
    assert "*(1) Project" in text and "Exchange" not in text


def test_preprocess_cleans_once_although_it_filters_on_the_result(spark, sf_dir):
    docs = tables.latin_docs(spark, sf_dir).withColumn("category", F.col("lang"))
    assert plan(preprocess(docs, order=["subset", "doc_id"])).count(CLEANING) == 1


def test_scoring_cleans_once(spark, sf_dir):
    from checks.model_queries import _pipeline

    scored = _pipeline(spark, sf_dir).transform(tables.styled(spark, sf_dir)).select("doc_id", "prediction", "probability")
    assert plan(scored).count(CLEANING) == 1


def test_counts_combine_before_the_shuffle(spark, sf_dir):
    terms = corpus.explode_terms(tables.processed(spark, sf_dir), keep=("category_encode",))
    text = final_plan(corpus.lexical_stats(corpus.term_counts_by_class(terms)))
    assert text.count(CLEANING) == 1
    assert "partial_count(1)" in text


def test_top_n_cuts_before_the_shuffle(spark):
    counts = spark.range(1000).selectExpr("'WORD' AS kind", "IF(id % 3 = 0, 'ALL', 'AI') AS class", "CAST(id AS string) AS term", "id AS n")
    text = plan(corpus.top_terms(counts, corpus.WORD))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_histogram_reads_the_texts_once(spark, sf_dir):
    text = final_plan(ttr_histogram(ttr_columns(add_clean_texts(tables.arabic_docs(spark, sf_dir)))))
    reused = text.count("ReusedExchange")
    assert reused >= 1 and text.count("FileScan") == 2  # documents and labels


def test_tfidf_tokenizes_once_and_joins_plain_exchanges(spark, sf_dir):
    docs = tables.table(spark, sf_dir, "documents").select("doc_id", tokenize_ws("text").alias("tokens"))
    text = plan(tfidf.tf_idf_table(docs, "doc_id"))
    assert "Generate" not in text and "Aggregate" not in text.split("Subquery")[0]
    assert plan(tfidf.document_frequency(docs)).split("== Initial")[0].count("regexp_extract_all") == 1


def test_a_term_in_every_document_is_split(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "1k",
    }
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        docs = spark.range(60_000).selectExpr("id AS doc", "array('the', concat('w', id % 5000)) AS tokens")
        table = tfidf.tf_idf_table(docs.repartition(8), "doc")
        assert "skew=true" in final_plan(table) and table.filter("term = 'the'").count() == 60_000
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_quantiles_and_curves_run_nothing_before_an_action(spark):
    df = spark.range(90).selectExpr("id", "CAST(id % 2 AS int) AS category_encode", "id / 90 AS score", "1.0 AS prediction")
    runs = df.selectExpr("*", "'m' AS model", "'val' AS split")
    spark.sparkContext.setJobGroup("plans", "building plans")
    try:
        quantiles_by_group(df, "category_encode", ["score"]), evaluation.roc_auc(df), evaluation.roc_curve(df)
        evaluation.metrics_table(runs), exact_split(df, "id")
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("plans")) == []
    finally:
        spark.sparkContext._jsc.clearJobGroup()


def test_quartiles_read_the_texts_once(spark, sf_dir):
    text = final_plan(entry.queries()["feature_quartiles"](spark, sf_dir))
    assert text.count(CLEANING) <= 1 + text.count("Subquery") and "ReusedExchange" in text


def test_labels_are_broadcast_only_when_small(spark, sf_dir):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(entry.queries()["attach_labels"](spark, sf_dir))
        assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan(entry.queries()["attach_labels"](spark, sf_dir))


def test_a_single_row_group_is_cleaned_by_several_tasks(spark, tmp_path):
    """Parquet never splits a row group, so the texts of one are dealt before they are cleaned; a stream is left alone."""
    path = str(tmp_path / "one")
    text = F.concat_ws(" ", F.lit("كتاب"), F.sha2(F.col("id").cast("string"), 512), F.sha2(F.concat(F.lit("x"), F.col("id").cast("string")), 512))
    spark.range(20_000).select("id", text.alias("text")).coalesce(1).write.parquet(path)
    cleaned = add_clean_texts(spark.read.parquet(path))
    used = cleaned.select(F.spark_partition_id().alias("p"), F.length("processed_text").alias("n")).filter("n >= 0")
    assert used.select("p").distinct().count() > 1
    stream = add_clean_texts(spark.readStream.schema("id long, text string").parquet(path))
    assert "Rebalance" not in stream._jdf.queryExecution().analyzed().toString()


def test_repeats_in_one_pass_are_those_of_both_rules(spark):
    """Two equal marks, three of any other character, and neither across a line feed."""
    rows = ["a..b", "aab", "aaab", "!!!!x??..", "\n\n\nab", "؟؟؟", "😀😀😀 😀😀", ",,,,..!", "aa..bbb...", "", "1 222 33"]
    df = spark.createDataFrame([(r,) for r in rows], "text string")
    one = F.regexp_replace("text", cleaning.REPEATED, "$1")
    two = cleaning.squeeze_elongation(cleaning.squeeze_punct("text"))
    assert [r[0] for r in df.select(one).collect()] == [r[0] for r in df.select(two).collect()]


def test_normalising_tries_blanks_only_and_gives_the_plain_rules(spark):
    """Single spaces are no match, both token patterns begin with the space, and no group of a failed try stays."""
    from quillmark.functions import drop_stopwords, fold_final, fold_letters, keep_script, light_stem, normalize_text, strip_marks
    from quillmark.functions.normalizing import suffix_pattern, token_pattern
    from quillmark.profiles import ARABIC

    rows = [" لز ا ورست", "ولا والكتابات　ا  ", "a b\tc", "", "الذين و بالمدرسه ون", "undersings a the ations reing  ings"]
    df = spark.createDataFrame([(r,) for r in rows], "text string")
    runs = df.select(F.regexp_count("text", F.lit(cleaning.BLANKS)).alias("n")).collect()
    assert [r["n"] for r in runs] == [0, 2, 1, 0, 0, 1]
    for profile in (ARABIC, LATIN):
        assert token_pattern(profile)[0] == suffix_pattern(profile)[0] == " "
        plain = keep_script(strip_marks(fold_final(fold_letters("text", profile), profile), profile), profile)
        kept = F.filter(drop_stopwords(tokenize_ws(plain), profile), lambda t: F.length(t) >= 2)
        wanted = F.array_join(F.transform(kept, lambda t: light_stem(t, profile)), " ")
        found = df.select(normalize_text("text", profile).alias("a"), wanted.alias("b")).collect()
        assert [r["a"] for r in found] == [r["b"] for r in found]


def test_style_of_a_batch_is_dealt_where_asked_and_for_stream_features(spark, tmp_path):
    """Messages of one row group are measured by several tasks, with the rows of the plain form; a stream is left alone."""
    from quillmark.streaming.scoring import stream_features

    path = str(tmp_path / "one")
    text = F.concat_ws(" ", F.lit("book"), F.sha2(F.col("id").cast("string"), 512), F.sha2(F.concat(F.lit("x"), F.col("id").cast("string")), 512))
    spark.range(20_000).select("id", text.alias("text")).coalesce(1).write.parquet(path)
    df = spark.read.parquet(path)
    for dealt in (stream_features(df, LATIN), add_style(df, LATIN, deal=True)):
        assert "rebalance" in dealt._jdf.queryExecution().optimizedPlan().toString().lower()
        assert dealt.select(F.spark_partition_id().alias("p"), "total_words").filter("total_words > 0").select("p").distinct().count() > 1
        assert dealt.exceptAll(add_style(df, LATIN)).count() == 0
    stream = stream_features(spark.readStream.schema("id long, text string").parquet(path), LATIN)
    assert "rebalance" not in stream._jdf.queryExecution().analyzed().toString().lower()


def test_a_text_without_mail_or_digits_is_one_match(spark):
    """Such a text is put back whole instead of being tried place by place; all others get both rules."""
    rows = ["plain words only", "ab@cd 12", "@ab", "x@", "١٢ كتاب", "a1a1a@b c", "", "@a@b", "line\nbreak", "7"]
    df = spark.createDataFrame([(r,) for r in rows], "text string")
    one = F.regexp_replace("text", cleaning.EMAIL_OR_DIGITS, "$1").alias("one")
    two = cleaning.strip_digits(cleaning.strip_emails("text")).alias("two")
    found = df.select(one, two, F.regexp_extract("text", cleaning.EMAIL_OR_DIGITS, 0).alias("first")).collect()
    assert [r["one"] for r in found] == [r["two"] for r in found]
    assert [r["first"] for r in found if r["first"] == r["one"] != ""] == ["plain words only", "line\nbreak"]


def test_unwanted_characters_are_one_class(spark):
    """One class gives what the rules for marks and script give, and no second alternative is tried."""
    from quillmark.functions import keep_script, strip_marks
    from quillmark.functions.normalizing import unwanted_pattern
    from quillmark.profiles import ARABIC

    df = spark.createDataFrame([("كِتَابٌ, abc ٰx　é́ ١!",), ("\x1c  a-b_cً",), ("",)], "text string")
    for profile in (ARABIC, LATIN):
        assert "|" not in unwanted_pattern(profile)
        both = df.select(F.regexp_replace("text", unwanted_pattern(profile), "").alias("a"), keep_script(strip_marks("text", profile), profile).alias("b"))
        assert all(r["a"] == r["b"] for r in both.collect())


@pytest.mark.parametrize("adjacency", ["filtered", "original", "blanks"])
def test_words_and_pairs_come_from_one_pattern(spark, adjacency):
    """Pairs are neighbours of the tokens found, not a second search; the rows are those of the plain rules."""
    from quillmark.functions import bigrams, min_token_length, script_bigrams, tokenize_script

    rows = [("كتاب و قلم جديد",), ("و",), ("كتاب",), ("",), (None,), ("ab c de f ghi 😀 jk",), ("كتاب x قلم كتاب قلم",)]
    df = spark.createDataFrame(rows, "processed_text string").withColumn("id", F.monotonically_increasing_id())
    if adjacency == "blanks":
        terms = corpus.explode_ws_terms(df, keep=("id",))
        pairs = F.filter(bigrams(tokenize_ws("processed_text"), " "), lambda p: p.rlike("^.{2,} .{2,}$"))
        words = min_token_length(tokenize_ws("processed_text"))
    else:
        terms = corpus.explode_terms(df, adjacency=adjacency, keep=("id",))
        pairs, words = script_bigrams("processed_text", adjacency=adjacency), tokenize_script("processed_text", min_length=2)
    assert final_plan(terms).count("regexp_extract_all") == 1
    plain = [df.select("id", F.lit(k).alias("kind"), F.explode(a).alias("term")) for k, a in (("WORD", words), ("BIGRAM", pairs))]
    wanted = plain[0].unionAll(plain[1])
    assert terms.exceptAll(wanted).count() == wanted.exceptAll(terms).count() == 0 < wanted.count()


def test_sql_terms_search_a_text_once(spark):
    from quillmark.functions.sql import table_definitions

    assert table_definitions()["terms"][1].count("regexp_extract_all") == 1


def test_model_and_its_copy_score_measures_that_are_stored_once(spark, tmp_path):
    """Unlabelled, unknown, repeated and missing documents among them; no text work is left in the plan."""
    from checks import model_queries

    texts = spark.range(60).selectExpr("id AS doc_id", "concat('River stone ', id, '. Some light!') AS text", "'en' AS lang", "'a' AS source", "20L AS n_chars")
    odd = spark.createDataFrame([(None, "no key", "en", "a", 6), (7, "seven again", "en", "a", 11), (60, None, "en", "a", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.range(40).selectExpr("id AS doc_id", "CAST(CASE WHEN id = 3 THEN NULL WHEN id = 4 THEN 7 ELSE id % 2 END AS int) AS quality", "0 AS toxic")
    texts.union(odd).write.parquet(f"{tmp_path}/documents.parquet")
    labels.union(labels.filter("doc_id = 5")).write.parquet(f"{tmp_path}/labels.parquet")
    columns = ["doc_id", "processed_text", *model_queries.STYLO_COLUMNS]
    once, wanted = model_queries._styled_once(spark, str(tmp_path)), model_queries.t.styled(spark, str(tmp_path)).select(*columns)
    assert once.exceptAll(wanted).isEmpty() and wanted.exceptAll(once).isEmpty()
    result = model_queries.model_roundtrip(spark, str(tmp_path))
    assert "regexp_replace" not in result._jdf.queryExecution().optimizedPlan().toString()
    found = result.filter("doc_id IS NOT NULL AND doc_id NOT IN (5, 7)").collect()
    assert len(found) == 59 and all(r["same"] for r in found)

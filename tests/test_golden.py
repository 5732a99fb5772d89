"""Hand-made rows: Arabic text and the edge cases."""

import pytest
from pyspark.sql import functions as F

from quillmark import functions as fn
from quillmark.operators import corpus, evaluation, reshape
from quillmark.operators.dedup import dedup_exact, subset_rank
from quillmark.profiles import ARABIC
from quillmark.sources import files


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "text string").select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, cleaned, processed",
    [
        (None, "", ""),
        ("", "", ""),
        (" \n ", "", ""),
        ("جمييييل!!!! ،،، ok...", "جميل! ، ok.", "جميل"),
        ("<b>x</b> https://a.b/c me@x.org ١٢3", "x", ""),
        ("مدرسة", "مدرسة", "مدرس"),
        ("مدرسةً", "مدرسةً", "مدرس"),
        ("مدرسة،", "مدرسة،", "مدرسه،"),
        ("مدرسةx", "مدرسةx", "مدرس"),
        ("أإآى", "أإآى", "ااي"),
        ("على إلى أن في", "على إلى أن في", "علي الي ان"),
        ("والكتاب استكشاف كتب", "والكتاب استكشاف كتب", "كتاب ستكشاف كتب"),
        ("الدراسة،", "الدراسة،", "دراسه،"),
        ("a < b << c", "a < b << c", ""),
        ("x <> y < z> w", "x <> y w", ""),
    ],
)
def test_clean_and_normalize(spark, text, cleaned, processed):
    row = spark.createDataFrame([(text,)], "text string").select(fn.clean_text("text").alias("c"))
    row = row.withColumn("p", fn.normalize_text("c")).first()
    assert (row["c"], row["p"]) == (cleaned, processed)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("me@x.org ok", " ok"),
        ("@x y@ @ a@b@", "@x y@ @ "),
        ("@@x", ""),
        ("a b@c d", "a  d"),
    ],
)
def test_strip_emails(spark, text, expected):
    assert one(spark, text, fn.strip_emails("text")) == expected


def test_fold_stopwords_option(spark):
    assert one(spark, "على إلى أن في", fn.normalize_text("text", ARABIC.folded())) == ""


def test_stopword_list():
    assert len(ARABIC.stopwords) == len(set(ARABIC.stopwords)) == 76


@pytest.mark.parametrize("text", [None, "", " \n "])
def test_defaults_of_blank_texts(spark, text):
    df = spark.createDataFrame([(text,)], "text string").withColumn("cleaned_text", fn.clean_text("text"))
    row = fn.stylometry(df).first()
    assert (row["total_words"], row["short_words_count"], row["short_words_ratio"]) == (0, 0, 0.0)
    assert (row["total_physical_lines"], row["total_sentences"]) == (1, 1)
    assert (row["foreign_letters_count"], row["foreign_letters_ratio"]) == (0, 0.0)
    assert (row["active_voice_count"], row["redundancy_score"]) == (0, 0.0)


def test_line_breaks(spark):
    assert one(spark, "a\r\nb\x0bc\x85d\u2028e\n\n  \nf", fn.total_physical_lines("text")) == 6


def test_sentences(spark):
    assert one(spark, "abcd. efg. %%%% hi; wxyz\n z", fn.total_sentences("text")) == 2
    assert one(spark, "abc d؟ ab    c!", fn.total_sentences("text")) == 2


def test_active_voice(spark):
    assert one(spark, "هذا نص. أُكتب النص هنا. نص آخر؟", fn.active_voice_count("text")) == 2
    assert one(spark, "كأُكتب النص هنا", fn.active_voice_count("text")) == 1  # marker inside a word


def test_foreign_letters(spark):
    df = spark.createDataFrame([("نص with Ελ 12",)], "text string")
    row = df.select(fn.foreign_letters_count("text").alias("n"), fn.foreign_letters_ratio("text").alias("r")).first()
    assert row["n"] == 6 and row["r"] == pytest.approx(6 / 8)


def test_redundancy(spark):
    assert one(spark, "a b a b", fn.redundancy_score("text")) == pytest.approx(1 / 3, abs=1e-6)
    assert one(spark, "a", fn.redundancy_score("text")) == 0.0


def test_bigram_adjacency(spark):
    # b is a one-letter token in Arabic script here
    text = "اب ج ده"
    assert one(spark, text, fn.script_bigrams("text", adjacency="original")) == []
    assert one(spark, text, fn.script_bigrams("text", adjacency="filtered")) == ["اب_ده"]


def test_ngrams(spark):
    assert one(spark, "a b c", fn.ngrams(fn.tokenize_ws("text"), 3)) == ["a b c"]
    assert one(spark, "a b", fn.ngrams(fn.tokenize_ws("text"), 3)) == []
    assert one(spark, "", fn.bigrams(fn.tokenize_ws("text"))) == []


def test_lenient_json(spark):
    lines = ['{"text":', "[1]", '{"x":1}', "12", "true", "null", '"hello"', '"my text"', '["text"]', "  ", '{"cleaned_text":"","text":"t"}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r["text"] for r in files.texts_of_lines(df).collect()}
    assert got == {'{"text":', "12", "true", "null", '"my text"', '["text"]', "t"}


def test_strict_json(spark):
    lines = ['{"text":', '{"processed_text":"a","category_encode":1}', '{"processed_text":"b","category_encode":7}',
             '{"processed_text":"c"}', '{"processed_text":"","category_encode":0}', '{"processed_text":"d","category_encode":0}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {(r["processed_text"], r["class"]) for r in files.parse_labelled_jsonl(df).collect()}
    assert got == {("a", "HUMAN"), ("b", "UNKNOWN"), ("c", "UNKNOWN"), ("d", "AI")}


def test_read_counts_skips_bad_lines(spark, tmp_path):
    path = tmp_path / "counts.tsv"
    path.write_text("WORD\ta\t3\nWORD\tb\nWORD\tc\tx\nWORD\td\t4\t5\nBIGRAM\ta_b\t1\n")
    rows = {tuple(r) for r in files.read_counts(spark, str(path)).collect()}
    assert rows == {("WORD", "a", 3), ("BIGRAM", "a_b", 1)}


def test_first_subset_survives(spark):
    rows = [("t", "b", "x"), ("t", "a", "y"), ("u", "b", "z")]
    df = spark.createDataFrame(rows, "text string, subset string, category string")
    kept = dedup_exact(df, "text", [subset_rank("subset", ["a", "b"]), F.col("category")])
    assert {tuple(r) for r in kept.collect()} == {("t", "a", "y"), ("u", "b", "z")}


def test_unknown_class_counts_in_all_only(spark):
    df = spark.createDataFrame([("اب جد", 1), ("اب", None), ("اب", 7)], "processed_text string, category_encode int")
    counts = corpus.term_counts_by_class(corpus.explode_terms(df, keep=("category_encode",)))
    words = {(r["class"], r["term"]): r["n"] for r in counts.filter("kind = 'WORD'").collect()}
    assert words == {("ALL", "اب"): 3, ("ALL", "جد"): 1, ("HUMAN", "اب"): 1, ("HUMAN", "جد"): 1}


def test_equal_counts_go_to_the_lower_term(spark):
    df = spark.createDataFrame([("WORD", "ALL", t, 2) for t in "cab"], "kind string, class string, term string, n bigint")
    assert [r["term"] for r in corpus.top_terms(df, "WORD", 2).orderBy("rank").collect()] == ["a", "b"]


def test_collapsed_classifier(spark):
    df = spark.createDataFrame([(0, 0.0)] * 4895 + [(1, 0.0)] * 431, "category_encode int, prediction double")
    confusion = evaluation.confusion_matrix(df)
    assert confusion.count() == 4
    human = evaluation.per_class_metrics(confusion).filter("class = 1").first()
    assert human["precision"] is None and human["recall"] == 0.0 and human["f1"] == 0.0
    means = evaluation.weighted_metrics(confusion).first()
    assert means["accuracy"] == pytest.approx(0.91908, abs=1e-5)
    assert means["f1"] == pytest.approx(0.88032, abs=1e-5)
    assert means["precision"] == pytest.approx(0.84470, abs=1e-5)


def test_published_per_class_metrics(spark):
    cells = [(0, 0, 4847), (0, 1, 48), (1, 0, 136), (1, 1, 295)]
    confusion = spark.createDataFrame(cells, "label int, prediction int, n bigint")
    rows = {r["class"]: r for r in evaluation.per_class_metrics(confusion).collect()}
    assert rows[1]["precision"] == pytest.approx(0.860, abs=1e-3)
    assert rows[1]["recall"] == pytest.approx(0.684, abs=1e-3)
    assert evaluation.weighted_metrics(confusion).first()["f1"] == pytest.approx(0.96364, abs=1e-5)


def test_distinctive_ratio(spark):
    wide = spark.createDataFrame([("BIGRAM", "a b", 3415, 0, 3415), ("BIGRAM", "c d", 99, 0, 99)],
                                 "kind string, term string, n_all bigint, n_human bigint, n_ai bigint")
    sizes = spark.createDataFrame([(0, 33532), (1, 2992)], "category_encode int, n bigint")
    rows = corpus.distinctive_terms(wide, sizes).collect()
    assert [r["term"] for r in rows] == ["a b"]
    assert rows[0]["ratio"] == pytest.approx(304.8, abs=0.05)


def test_required_columns(spark):
    df = spark.range(1)
    with pytest.raises(ValueError, match="text"):
        reshape.require_columns(df, ["id", "text"])


def test_empty_inputs_are_refused(spark):
    with pytest.raises(ValueError):
        reshape.union_subsets([])
    with pytest.raises(ValueError):
        reshape.melt_texts(spark.range(1))
    with pytest.raises(ValueError):
        fn.script_bigrams("text", adjacency="other")

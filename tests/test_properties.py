"""Expressions against plain Python on generated texts."""

import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillmark import functions as fn
from quillmark.operators.splits import stratified_split
from quillmark.profiles import ARABIC, LATIN

BLANKS = [" ", "\n", "\t", "\r", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "\xa0", "\u2009", "\u2028", "\u3000"]
ALPHABET = list("aaabbcsdé<>@.!?,:;-()[]\"'_0٣9") + list("اأةىلولستنيهكمُّ،؟؛") + ["–", "ʼ", "😀", "http", "www", "@x", "  "] + BLANKS


def texts(n=400, seed=11):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(ALPHABET, k=rnd.randint(0, 60))) for _ in range(n)]


def evaluate(spark, values, column):
    df = spark.createDataFrame(list(enumerate(values)), "i int, text string")
    rows = df.select("i", column.alias("x")).collect()
    return [r["x"] for r in sorted(rows, key=lambda r: r["i"])]


def check(spark, column, brute, values=None):
    values = values or texts()
    for text, got in zip(values, evaluate(spark, values, column)):
        assert got == brute(text), repr(text)


def collapse(text, pattern, to=""):
    return re.sub(pattern, to, text)


CLEANING = {
    "strip_html": (fn.strip_html, lambda t: collapse(t, "<[^>]+>")),
    "strip_urls": (fn.strip_urls, lambda t: collapse(t, r"(http|www)\S+")),
    "strip_emails": (fn.strip_emails, lambda t: collapse(t, r"\S+@\S+")),
    "strip_digits": (fn.strip_digits, lambda t: collapse(t, r"\d+")),
    "squeeze_punct": (fn.squeeze_punct, lambda t: collapse(t, r"([؟!.,])\1+", r"\1")),
    "squeeze_elongation": (fn.squeeze_elongation, lambda t: collapse(t, r"(.)\1\1+", r"\1")),
    "squeeze_space": (fn.squeeze_space, lambda t: " ".join(t.split())),
}


@pytest.mark.parametrize("name", CLEANING)
def test_cleaning_rule(spark, name):
    rule, brute = CLEANING[name]
    check(spark, rule("text"), brute)


def test_clean_text_is_the_rules_in_order(spark):
    def brute(text):
        for _, rule in CLEANING.values():
            text = rule(text)
        return text

    check(spark, fn.clean_text("text"), brute, texts(1500, seed=5))


def test_clean_text_leaves_no_digits_or_double_blanks(spark):
    for text in evaluate(spark, texts(), fn.clean_text("text")):
        assert not re.search(r"\d|\s\s|^\s|\s$", text), repr(text)


def test_counts(spark):
    check(spark, fn.total_words("text"), lambda t: len(t.split()))
    check(spark, fn.short_words_count("text"), lambda t: sum(len(w) < 4 for w in t.split()))
    check(spark, fn.tokenize_ws("text"), str.split)
    check(spark, fn.total_physical_lines("text"), lambda t: max(1, sum(bool(line.strip()) for line in t.splitlines())))


@pytest.mark.parametrize("profile", [ARABIC, LATIN], ids=lambda p: p.name)
def test_sentences(spark, profile):
    def brute(text):
        text = " ".join(text.split())
        runs = re.split("[" + re.escape(profile.segment_marks) + "]+", text)
        return max(1, sum(len(r.strip()) > 3 and bool(re.search(r"\w", r)) for r in runs))

    check(spark, fn.total_sentences("text", profile), brute)


def test_active_voice(spark):
    passive = re.compile("\\bأُ[\u064b-\u065f]?[\u0627-\u064a]|\\bاست\u0651")

    def brute(text):
        runs = re.split("[" + re.escape(ARABIC.sentence_marks) + "]+", text)
        return sum(len(r.strip()) > 3 and not passive.search(r) for r in runs)

    check(spark, fn.active_voice_count("text"), brute)


def test_foreign_letters(spark):
    def brute(text):
        return sum(c.isalpha() and not re.match("[\u0600-\u06ff\u0750-\u077f\u08a0-\u08ff\ufb50-\ufdff\ufe70-\ufeff]", c) for c in text)

    check(spark, fn.foreign_letters_count("text"), brute)


def test_redundancy(spark):
    def brute(text):
        words = text.split()
        pairs = list(zip(words, words[1:]))
        return 1 - len(set(pairs)) / len(pairs) if pairs else 0.0

    values = texts()
    for text, got in zip(values, evaluate(spark, values, fn.redundancy_score("text"))):
        assert got == pytest.approx(brute(text), abs=1e-6), repr(text)


@pytest.mark.parametrize("profile", [ARABIC, LATIN], ids=lambda p: p.name)
def test_normalize_is_the_token_rules_in_order(spark, profile):
    letters = fn.keep_script(fn.strip_marks(fn.fold_final(fn.fold_letters("text", profile), profile), profile), profile)
    tokens = fn.min_token_length(fn.drop_stopwords(fn.tokenize_ws(letters), profile))
    stepwise = F.array_join(F.transform(tokens, lambda t: fn.light_stem(t, profile)), " ")
    values = texts(800, seed=3) + [" ".join(profile.stopwords)]
    assert evaluate(spark, values, fn.normalize_text("text", profile)) == evaluate(spark, values, stepwise)


def stem_by_hand(word, profile):
    fits = lambda affix: len(word) - len(affix) >= profile.min_stem
    longest = lambda found: max(found, key=len, default="")
    word = word[len(longest(p for p in profile.prefixes if word.startswith(p) and fits(p))):]
    fits = lambda affix: len(word) - len(affix) >= profile.min_stem
    return word[: len(word) - len(longest(s for s in profile.suffixes if word.endswith(s) and fits(s)))]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(words=st.lists(st.text("البكفولستيهمنة", min_size=1, max_size=9), min_size=60, max_size=60))
def test_light_stem(spark, words):
    assert evaluate(spark, words, fn.light_stem("text")) == [stem_by_hand(w, ARABIC) for w in words]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.lists(st.text("ابجد", min_size=1, max_size=3), max_size=8), min_size=30, max_size=30))
def test_bigrams(spark, rows):
    values = [" ".join(r) for r in rows]
    pairs = [[f"{a}_{b}" for a, b in zip(r, r[1:])] for r in rows]
    assert evaluate(spark, values, fn.bigrams(fn.tokenize_ws("text"))) == pairs
    longer = [[w for w in r if len(w) > 1] for r in rows]
    assert evaluate(spark, values, fn.script_bigrams("text")) == [[f"{a}_{b}" for a, b in zip(r, r[1:])] for r in longer]
    both = [[f"{a}_{b}" for a, b in zip(r, r[1:]) if len(a) > 1 and len(b) > 1] for r in rows]
    assert evaluate(spark, values, fn.script_bigrams("text", adjacency="original")) == both


def test_rules_stay_fast_on_long_runs(spark):
    """Texts that make a backtracking matcher quadratic."""
    n = 200_000
    values = ["x" * n, "<" * n, "@" * n, "a@" * (n // 2), "%" * n, "ا" * n, "أُ" * (n // 2), "-" * n, "a b " * (n // 4)]
    df = spark.createDataFrame([(v,) for v in values], "text string").withColumn("cleaned_text", fn.clean_text("text"))
    rows = fn.stylometry(df).withColumn("processed_text", fn.normalize_text("text"))
    assert rows.drop("text").agg(F.count("*").alias("n"), F.sum("total_sentences")).first()["n"] == len(values)


def test_trimming_stays_fast_on_long_runs_of_blanks(spark):
    from quillmark.sources.files import texts_of_lines

    n = 200_000
    blank = " " * n
    lines = ["a" + blank + "b", blank + "c" + blank, blank, "a " * (n // 2) + "d", "\t\u00a0" * (n // 2) + "e" + "\u3000" * n]
    got = [r["text"] for r in texts_of_lines(spark.createDataFrame([(v,) for v in lines], "value string")).collect()]
    assert got == ["a" + blank + "b", "c", "a " * (n // 2) + "d", "e"]


def test_exact_split_has_exact_proportions(spark):
    from quillmark.operators.splits import exact_split

    sizes = {0: 1003, 1: 3}
    rows = [(f"{c}-{i}", c) for c, n in sizes.items() for i in range(n)] + [("x", None), (None, 1), ("y", 2)]
    df = spark.createDataFrame(rows, "id string, category_encode int")
    split = exact_split(df.repartition(5), "id")
    assert {tuple(r) for r in split.collect()} == {tuple(r) for r in exact_split(df, "id").collect()}
    got = {(r["category_encode"], r["split"]): r["count"] for r in split.groupBy("category_encode", "split").count().collect()}
    for c, n in sizes.items():
        ends = [0, round(n * 0.7), round(n * 0.85), n]
        assert [got.get((c, s), 0) for s in ("train", "val", "test")] == [b - a for a, b in zip(ends, ends[1:])]


@pytest.mark.parametrize("n, ends", [(45, (32, 38)), (85, (60, 72)), (88145, (61702, 74923))])
def test_exact_split_rounds_halves_up_as_decimals_do(spark, n, ends):
    from quillmark.operators.splits import exact_split

    df = spark.range(n).select("id", F.lit(1).alias("category_encode"))
    got = {r["split"]: r["count"] for r in exact_split(df, "id").groupBy("split").count().collect()}
    assert got == {"train": ends[0], "val": ends[1] - ends[0], "test": n - ends[1]}


def test_split_is_a_stable_partition(spark):
    df = spark.range(5000).withColumn("category_encode", F.when(F.col("id") % 11 == 0, 1).when(F.col("id") % 7 == 0, None).otherwise(0))
    split = stratified_split(df, "id")
    again = stratified_split(df.repartition(7), "id")
    assert {tuple(r) for r in split.collect()} == {tuple(r) for r in again.collect()}
    assert split.count() == df.filter("category_encode IN (0, 1)").count()
    for label in (0, 1):
        part = split.filter(F.col("category_encode") == label)
        shares = {r["split"]: r["count"] / part.count() for r in part.groupBy("split").count().collect()}
        assert shares["train"] == pytest.approx(0.70, abs=0.05)
        assert shares["val"] == pytest.approx(0.15, abs=0.04) and shares["test"] == pytest.approx(0.15, abs=0.04)
    assert stratified_split(df, "id", seed=7).filter("split = 'train'").exceptAll(split.filter("split = 'train'")).count()

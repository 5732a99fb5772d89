"""Cleaning, normalising, tokens and style."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql as q
from checks import tables as t
from checks.registry import query
from quillmark import functions as fn
from quillmark.operators.features import tfidf_stages
from quillmark.profiles import ARABIC, LATIN

# ---- cleaning: one rule each, on documents or pages -----------------------------------------


def _rule(name, rule, fragment, table="documents", key="doc_id", text="text"):
    @query(name, f"SELECT {key}, {fragment(text)} AS result FROM {table}")
    def run(spark, sf_dir):
        return t.table(spark, sf_dir, table).select(key, rule(text).alias("result"))


_rule("strip_html", fn.strip_html, q.html, "pages", "page_id", "html")
_rule("strip_html_documents", fn.strip_html, q.html)
_rule("strip_urls", fn.strip_urls, q.urls)
_rule("strip_urls_pages", fn.strip_urls, q.urls, "pages", "page_id", "html")
_rule("strip_emails", fn.strip_emails, q.emails)
_rule("strip_digits", fn.strip_digits, q.digits)
_rule("squeeze_punct", fn.squeeze_punct, q.punct)
_rule("squeeze_space", fn.squeeze_space, q.space)


@query(
    "squeeze_elongation",
    f"""WITH c AS (SELECT doc_id, {q.characters('text')} AS cs FROM documents)
        SELECT doc_id, {q.elongation('cs')} AS result FROM c""",
)
def squeeze_elongation(spark, sf_dir):
    return t.documents(spark, sf_dir).select("doc_id", fn.squeeze_elongation("text").alias("result"))


@query("clean_text", f"WITH {q.clean_ctes('documents')} SELECT doc_id, cleaned_text FROM cleaned")
def clean_text(spark, sf_dir):
    return t.documents(spark, sf_dir).select("doc_id", fn.clean_text("text").alias("cleaned_text"))


@query(
    "clean_text_pages",
    f"WITH base AS (SELECT page_id, html AS text FROM pages), {q.clean_ctes('base')} SELECT page_id, cleaned_text FROM cleaned",
)
def clean_text_pages(spark, sf_dir):
    return t.table(spark, sf_dir, "pages").select("page_id", fn.clean_text("html").alias("cleaned_text"))


# ---- normalising, on texts in Arabic letters ------------------------------------------------


def _arabic_rule(name, rule, fragment):
    @query(name, f"WITH {q.ARABIC_DOCS} SELECT doc_id, {fragment('text', ARABIC)} AS result FROM docs")
    def run(spark, sf_dir):
        return t.arabic_docs(spark, sf_dir).select("doc_id", rule("text", ARABIC).alias("result"))


_arabic_rule("fold_letters", fn.fold_letters, q.fold)
_arabic_rule("fold_ta_marbuta", fn.fold_final, q.fold_final)
_arabic_rule("strip_diacritics", fn.strip_marks, q.marks)
_arabic_rule("keep_script", fn.keep_script, q.keep)


@query("normalize_text", f"WITH {q.PROCESSED} SELECT doc_id, processed_text FROM processed")
def normalize_text(spark, sf_dir):
    return t.processed(spark, sf_dir).select("doc_id", "processed_text")


@query("normalize_text_latin", f"SELECT doc_id, {q.normalized('text', LATIN)} AS processed_text FROM documents")
def normalize_text_latin(spark, sf_dir):
    return t.documents(spark, sf_dir).select("doc_id", fn.normalize_text("text", LATIN).alias("processed_text"))


_FOLDED = ARABIC.folded()


@query(
    "normalize_text_folded_stopwords",
    f"""WITH {q.ARABIC_DOCS}, {q.clean_ctes('docs')}
        SELECT doc_id, {q.normalized('cleaned_text', ARABIC).replace(q.quoted(ARABIC.stopwords), q.quoted(_FOLDED.stopwords))}
            AS processed_text FROM cleaned""",
)
def normalize_text_folded(spark, sf_dir):
    cleaned = t.arabic_docs(spark, sf_dir).withColumn("cleaned_text", fn.clean_text("text"))
    return cleaned.select("doc_id", fn.normalize_text("cleaned_text", _FOLDED).alias("processed_text"))


# ---- tokens: one row per document, the whole token list as one string -----------------------


def _tokens(name, tokens, fragment, arabic=False):
    """``tokens`` makes an array column; ``fragment`` the list in SQL over ``ts``, the tokens it starts from."""
    start, made = fragment if isinstance(fragment, tuple) else (fragment, "ts")
    ctes = f"{q.ARABIC_DOCS}," if arabic else ""

    @query(
        name,
        f"""WITH {ctes} _start AS (SELECT doc_id, {start} AS ts FROM {'docs' if arabic else 'documents'}),
            _made AS (SELECT doc_id, {made} AS ts FROM _start)
            SELECT doc_id, len(ts)::INT AS n, array_to_string(ts, ' | ') AS tokens FROM _made""",
    )
    def run(spark, sf_dir):
        docs = t.arabic_docs(spark, sf_dir) if arabic else t.documents(spark, sf_dir)
        made = docs.select("doc_id", tokens().alias("ts"))
        return made.select("doc_id", F.size("ts").alias("n"), F.array_join("ts", " | ").alias("tokens"))


_tokens("tokenize_ws", lambda: fn.tokenize_ws("text"), q.tokens("text"))
_tokens("tokenize_script", lambda: fn.tokenize_script("text", ARABIC), q.script_tokens("text", ARABIC), arabic=True)
_tokens("tokenize_script_latin", lambda: fn.tokenize_script("text", LATIN, min_length=2), q.script_tokens("text", LATIN, 2))
_tokens(
    "drop_stopwords",
    lambda: fn.drop_stopwords(fn.tokenize_ws("text"), LATIN),
    f"list_filter({q.tokens('text')}, lambda t: t NOT IN ({q.quoted(LATIN.stopwords)}))",
)
_tokens(
    "min_token_length",
    lambda: fn.min_token_length(fn.tokenize_ws("text")),
    f"list_filter({q.tokens('text')}, lambda t: length(t) >= 2)",
)
_tokens(
    "light_stem",
    lambda: F.transform(fn.tokenize_script("text", ARABIC), lambda token: fn.light_stem(token, ARABIC)),
    (q.script_tokens("text", ARABIC), q.stem_list("ts", ARABIC)),
    arabic=True,
)
_tokens("bigrams", lambda: fn.bigrams(fn.tokenize_ws("text")), (q.tokens("text"), q.pairs("ts", "_")))
_tokens(
    "ngrams",
    lambda: fn.ngrams(fn.tokenize_ws("text"), 3),
    (q.tokens("text"), "list_transform(range(1, len(ts) - 1), lambda i: ts[i] || ' ' || ts[i + 1] || ' ' || ts[i + 2])"),
)
_tokens(
    "bigram_adjacency",
    lambda: fn.script_bigrams("text", ARABIC, adjacency="original"),
    (q.script_tokens("text", ARABIC), q.long_pairs("ts", "_")),
    arabic=True,
)
_tokens(
    "bigram_adjacency_filtered",
    lambda: fn.script_bigrams("text", ARABIC, adjacency="filtered"),
    (q.script_tokens("text", ARABIC, 2), q.pairs("ts", "_")),
    arabic=True,
)


@query(
    "regex_tokens",
    f"""WITH l AS (SELECT doc_id, {q.tokens('lower(text)')} AS ts FROM documents)
        SELECT doc_id, len(ts)::INT AS n, array_to_string(ts, ' | ') AS tokens FROM l""",
)
def regex_tokens(spark, sf_dir):
    stage, *_ = tfidf_stages("text")
    made = stage.transform(t.documents(spark, sf_dir))
    return made.select("doc_id", F.size("tokens").alias("n"), F.array_join("tokens", " | ").alias("tokens"))


# ---- style ----------------------------------------------------------------------------------


def _six(c, name):
    return F.round(c.cast("double"), 6).alias(name)


@query("total_words", f"SELECT doc_id, {q.words('text')} AS total_words FROM documents")
def total_words(spark, sf_dir):
    return t.documents(spark, sf_dir).select("doc_id", fn.total_words("text").alias("total_words"))


@query(
    "short_words",
    f"""SELECT doc_id, {q.short_words('text')} AS short_words_count,
        round(CAST({q.ratio(q.short_words('text'), q.words('text'))} AS DOUBLE), 6) AS short_words_ratio FROM documents""",
)
def short_words(spark, sf_dir):
    return t.documents(spark, sf_dir).select(
        "doc_id",
        fn.short_words_count("text").alias("short_words_count"),
        _six(fn.short_words_ratio("text"), "short_words_ratio"),
    )


@query("physical_lines", f"SELECT doc_id, {q.lines('text')} AS total_physical_lines FROM documents")
def physical_lines(spark, sf_dir):
    return t.documents(spark, sf_dir).select("doc_id", fn.total_physical_lines("text").alias("total_physical_lines"))


@query("sentences", f"WITH {q.ARABIC_DOCS} SELECT doc_id, {q.sentences('text', ARABIC)} AS total_sentences FROM docs")
def sentences(spark, sf_dir):
    return t.arabic_docs(spark, sf_dir).select("doc_id", fn.total_sentences("text").alias("total_sentences"))


@query(
    "foreign_letters",
    f"""WITH {q.ARABIC_DOCS} SELECT doc_id, {q.foreign('text', ARABIC)} AS foreign_letters_count,
        round(CAST({q.ratio(q.foreign('text', ARABIC), q.letters('text'))} AS DOUBLE), 6) AS foreign_letters_ratio FROM docs""",
)
def foreign_letters(spark, sf_dir):
    return t.arabic_docs(spark, sf_dir).select(
        "doc_id",
        fn.foreign_letters_count("text").alias("foreign_letters_count"),
        _six(fn.foreign_letters_ratio("text"), "foreign_letters_ratio"),
    )


@query("active_voice", f"WITH {q.ARABIC_DOCS} SELECT doc_id, {q.active('text', ARABIC)} AS active_voice_count FROM docs")
def active_voice(spark, sf_dir):
    return t.arabic_docs(spark, sf_dir).select("doc_id", fn.active_voice_count("text").alias("active_voice_count"))


@query(
    "redundancy",
    f"""WITH t AS (SELECT doc_id, {q.tokens('text')} AS ts FROM documents), p AS (SELECT doc_id, {q.pairs('ts', ' ')} AS ps FROM t)
        SELECT doc_id, round(CAST({q.redundancy('ps')} AS DOUBLE), 6) AS redundancy_score FROM p""",
)
def redundancy(spark, sf_dir):
    return t.documents(spark, sf_dir).select("doc_id", _six(fn.redundancy_score("text"), "redundancy_score"))


def _measures(df, *keys):
    cols = (_six(F.col(c), c) if c in q.RATIOS else F.col(c) for c in q.ALL_MEASURES)
    return df.select(*keys, *cols)


@query("stylometry_all", f"WITH {q.LATIN_STYLE} SELECT doc_id, {q.measures()} FROM styled")
def stylometry_all(spark, sf_dir):
    return _measures(t.styled(spark, sf_dir), "doc_id")


@query(
    "stylometry_arabic",
    f"WITH {q.ARABIC_DOCS}, {q.clean_ctes('docs')}, {q.style_ctes(ARABIC)} SELECT doc_id, {q.measures()} FROM styled",
)
def stylometry_arabic(spark, sf_dir):
    return _measures(fn.stylometry(t.processed(spark, sf_dir), profile=ARABIC), "doc_id")


@query(
    "doc_ttr",
    f"""WITH {q.PROCESSED}, t AS (SELECT doc_id, {q.tokens('processed_text')} AS ts FROM processed)
        SELECT doc_id, len(list_distinct(ts))::INT AS unique_tokens, len(ts)::INT AS token_count,
            round(CAST({q.ratio('len(list_distinct(ts))', 'len(ts)')} AS DOUBLE), 6) AS doc_ttr FROM t""",
)
def doc_ttr(spark, sf_dir):
    rows = fn.ttr_columns(t.processed(spark, sf_dir))
    return rows.select("doc_id", "unique_tokens", "token_count", _six(F.col("doc_ttr"), "doc_ttr"))




@query(
    "sql_functions",
    f"""WITH docs AS (SELECT doc_id, text FROM documents), {q.clean_ctes('docs')}, {q.style_ctes(LATIN)}
        SELECT doc_id, cleaned_text, {q.normalized('cleaned_text', LATIN)} AS processed_text, {q.measures()} FROM styled""",
)
def sql_functions(spark, sf_dir):
    fn.register_sql_functions(spark, LATIN)
    t.documents(spark, sf_dir).createOrReplaceTempView("qm_documents")
    raw = ("total_physical_lines", "total_sentences", "foreign_letters_count", "foreign_letters_ratio", "active_voice_count")
    calls = (f"qm_{c}({'text' if c in raw else 'cleaned_text'}) AS {c}" for c in q.ALL_MEASURES)
    rows = spark.sql(
        f"""WITH c AS (SELECT doc_id, text, qm_clean_text(text) AS cleaned_text FROM qm_documents)
            SELECT doc_id, cleaned_text, qm_normalize_text(cleaned_text) AS processed_text, {', '.join(calls)} FROM c"""
    )
    return _measures(rows, "doc_id", "cleaned_text", "processed_text")

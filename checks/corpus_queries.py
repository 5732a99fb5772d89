"""Sources, reshaping, duplicates, summaries, corpus statistics, joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import sql as q
from checks import tables as t
from checks.registry import ORACLES, query
from quillmark.functions import tokenize_ws, ttr_columns
from quillmark.functions.sql import register_table_functions
from quillmark.operators import corpus, dedup, labels, reshape, sketches, summaries
from quillmark.plans import reports
from quillmark.plans.preparation import add_clean_texts, preprocess
from quillmark.profiles import LATIN
from quillmark.sources import count_store, files, layout, streams
from quillmark.sources.scratch import scratch_dir, stored

LANGS = ["en", "de", "es", "fr"]


def _six(name, alias=None):
    return F.round(F.col(name).cast("double"), 6).alias(alias or name)


# ---- sources and sinks ----------------------------------------------------------------------


@query("scan_subset", "SELECT 'documents' AS subset, doc_id, n_chars FROM documents")
def scan_subset(spark, sf_dir):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    return files.read_subset(spark, sf_dir, "documents", schema).select("subset", "doc_id", "n_chars")


@query("scan_project", "SELECT doc_id, lang FROM documents")
def scan_project(spark, sf_dir):
    return files.read_corpus(spark, f"{sf_dir}/documents.parquet", ("doc_id", "lang"))


@query("parquet_roundtrip", "SELECT doc_id, lang, source, md5(text) AS digest FROM documents")
def parquet_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "corpus")
    files.write_corpus(t.documents(spark, sf_dir), path, partition_by=("lang",))
    back = files.read_corpus(spark, path, ("doc_id", "lang", "source", "text"))
    return back.select("doc_id", "lang", "source", F.md5("text").alias("digest"))


@query("jsonl_roundtrip", f"WITH {q.LATIN_DOCS} SELECT doc_id, category_encode, md5(text) AS digest FROM docs WHERE text IS NOT NULL")
def jsonl_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "jsonl")
    files.write_jsonl(t.latin_docs(spark, sf_dir), path, ("doc_id", "text", "category_encode"), "text")
    back = spark.read.schema("doc_id bigint, text string, category_encode int").json(path)
    return back.select("doc_id", "category_encode", F.md5("text").alias("digest"))


@query(
    "lenient_json_text",
    rf"""WITH lines AS (SELECT unnest(string_split_regex(text, '\r\n|\r|\n')) AS l FROM conversations),
        bare AS (SELECT {q.replace('l', f'^[{q.WS}]+|[{q.WS}]+$')} AS text FROM lines)
        SELECT text FROM bare WHERE text <> '' UNION ALL SELECT text FROM conversations WHERE text <> ''
        UNION ALL SELECT turn::VARCHAR FROM conversations""",
)
def lenient_json_text(spark, sf_dir):
    path = scratch_dir(spark, "lines")
    turns = t.table(spark, sf_dir, "conversations")
    kinds = F.array(
        F.col("text"),  # plain lines
        F.to_json(F.struct(F.lit("").alias("cleaned_text"), "text")),  # objects, first field empty
        F.to_json(F.struct("turn", "role")),  # objects without a text
        F.to_json(F.array("role")),  # lists
        F.col("turn").cast("string"),  # numbers
    )
    turns.select(F.explode(kinds).alias("line")).write.text(path)
    return files.read_text_or_json(spark, path)


_CLASS = "CASE role WHEN 'user' THEN 1 WHEN 'assistant' THEN 0 END"


@query(
    "strict_json_text",
    f"""SELECT text AS processed_text, {_CLASS} AS category_encode,
        CASE role WHEN 'user' THEN 'HUMAN' WHEN 'assistant' THEN 'AI' ELSE 'UNKNOWN' END AS class
        FROM conversations WHERE text <> ''""",
)
def strict_json_text(spark, sf_dir):
    turns = t.messages(spark, sf_dir)
    record = F.to_json(F.struct(F.col("text").alias("processed_text"), F.col("true_label").alias("category_encode")))
    lines = F.array(record, F.concat(F.lit("{"), record), F.col("text"), F.to_json(F.struct("turn")))
    return files.parse_labelled_jsonl(turns.select(F.explode(lines).alias("value")))


_ARABIC_TERMS = f"""{q.PROCESSED},
    _tk AS (SELECT category_encode, {q.script_tokens('processed_text', q.ARABIC, 2)} AS ts FROM processed),
    _pr AS (SELECT *, {q.pairs('ts', '_')} AS ps FROM _tk),
    terms AS (SELECT 'WORD' AS kind, category_encode, unnest(ts) AS term FROM _pr
        UNION ALL SELECT 'BIGRAM', category_encode, unnest(ps) FROM _pr)"""

_CLASS_COUNTS = f"""{_ARABIC_TERMS},
    wide AS (SELECT kind, term, count(*) AS n_all, count(*) FILTER (WHERE category_encode = 1) AS n_human,
        count(*) FILTER (WHERE category_encode = 0) AS n_ai FROM terms GROUP BY kind, term),
    counts AS (SELECT kind, term, 'ALL' AS class, n_all AS n FROM wide UNION ALL
        SELECT kind, term, 'HUMAN', n_human FROM wide WHERE n_human > 0 UNION ALL
        SELECT kind, term, 'AI', n_ai FROM wide WHERE n_ai > 0)"""


def _terms(spark, sf_dir):
    return corpus.explode_terms(t.processed(spark, sf_dir), keep=("category_encode",))


def _counts(spark, sf_dir):
    return corpus.term_counts_by_class(_terms(spark, sf_dir))


@query(
    "counts_tsv_roundtrip",
    f"WITH {_CLASS_COUNTS} SELECT kind || '_' || class AS type, term AS key, n AS count FROM counts",
)
def counts_tsv_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "counts")
    files.write_counts(corpus.typed_counts(_counts(spark, sf_dir)), path)
    return files.read_counts(spark, path)


@query("decode_messages", f"SELECT conv_id, turn, text, {_CLASS} AS true_label FROM conversations")
def decode_messages(spark, sf_dir):
    value = F.to_json(F.struct("text", "true_label")).cast("binary").alias("value")
    return streams.decode_messages(t.messages(spark, sf_dir).select("conv_id", "turn", value), keep=("conv_id", "turn"))


@query("report_roundtrip", "SELECT 'class' || quality AS metric, count(*)::DOUBLE AS value FROM labels GROUP BY quality")
def report_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "report")
    sizes = summaries.class_distribution(t.table(spark, sf_dir, "labels"), "quality")
    name = F.concat(F.lit("class"), F.col("quality").cast("string")).alias("metric")
    files.write_report(sizes.select(name, F.col("n").cast("double").alias("value")), path)
    return spark.read.schema("metric string, value double").json(path)


# ---- reshape --------------------------------------------------------------------------------

_MELTED = f"""{q.WIDE}, melted AS (FROM wide
    UNPIVOT INCLUDE NULLS (text FOR category IN (user_text, assistant_text, system_text)))"""


def _melted(spark, sf_dir):
    return reshape.melt_texts(t.wide(spark, sf_dir), "_text", ["conv_id", "turn"])


@query("melt_wide_long", f"WITH {_MELTED} SELECT conv_id, turn, category, md5(text) AS digest FROM melted")
def melt_wide_long(spark, sf_dir):
    return _melted(spark, sf_dir).select("conv_id", "turn", "category", F.md5("text").alias("digest"))


@query(
    "encode_label",
    f"""WITH {_MELTED} SELECT conv_id, turn, category, md5(text) AS digest, (category = 'user_text')::INT AS category_encode
        FROM melted""",
)
def encode_label(spark, sf_dir):
    encoded = reshape.encode_label(_melted(spark, sf_dir), "user_text")
    return encoded.select("conv_id", "turn", "category", F.md5("text").alias("digest"), "category_encode")


@query(
    "drop_missing",
    f"""WITH {_MELTED} SELECT conv_id, turn, category, md5(text) AS digest FROM melted
        WHERE text IS NOT NULL AND category IS NOT NULL""",
)
def drop_missing(spark, sf_dir):
    known = reshape.drop_missing(_melted(spark, sf_dir), ["text", "category"])
    return known.select("conv_id", "turn", "category", F.md5("text").alias("digest"))


@query(
    "union_by_name",
    """SELECT 'documents' AS subset, doc_id, md5(text) AS digest FROM documents
       UNION ALL BY NAME SELECT md5(text) AS digest, 'benchmark' AS subset, item_id AS doc_id FROM benchmark""",
)
def union_by_name(spark, sf_dir):
    docs = t.documents(spark, sf_dir).select("doc_id", F.md5("text").alias("digest"))
    items = t.table(spark, sf_dir, "benchmark").select(F.md5("text").alias("digest"), F.col("item_id").alias("doc_id"))
    return reshape.union_subsets([reshape.tag_subset(docs, "documents"), reshape.tag_subset(items, "benchmark")])


_RANK = "CASE lang " + " ".join(f"WHEN '{lang}' THEN {i}" for i, lang in enumerate(LANGS)) + f" ELSE {len(LANGS)} END"


@query(
    "dedup_exact",
    f"""SELECT doc_id, lang, source, md5(text) AS digest FROM documents
        QUALIFY row_number() OVER (PARTITION BY text ORDER BY {_RANK}, source, doc_id) = 1""",
)
def dedup_exact(spark, sf_dir):
    order = [dedup.subset_rank("lang", LANGS), "source", "doc_id"]
    kept = dedup.dedup_exact(t.documents(spark, sf_dir), "text", order)
    return kept.select("doc_id", "lang", "source", F.md5("text").alias("digest"))


@query(
    "dedup_report",
    """SELECT count(*) AS rows_before, count(DISTINCT text) AS rows_after, count(*) - count(DISTINCT text) AS rows_dropped
       FROM documents""",
)
def dedup_report(spark, sf_dir):
    return dedup.dedup_report(t.documents(spark, sf_dir))


@query("drop_empty_processed", f"WITH {q.PROCESSED} SELECT doc_id, length(processed_text) AS n FROM processed WHERE length(processed_text) > 0")
def drop_empty_processed(spark, sf_dir):
    docs = reshape.drop_empty(add_clean_texts(t.arabic_docs(spark, sf_dir), filtered=True))
    return docs.select("doc_id", F.length("processed_text").alias("n"))


@query(
    "preprocess_corpus",
    f"""WITH {q.ARABIC_DOCS}, base AS (SELECT * FROM docs WHERE text IS NOT NULL
            QUALIFY row_number() OVER (PARTITION BY text ORDER BY subset, doc_id) = 1),
        {q.clean_ctes('base')}, done AS (SELECT *, {q.normalized('cleaned_text', q.ARABIC)} AS processed_text FROM cleaned)
        SELECT doc_id, subset, processed_text FROM done WHERE processed_text <> ''""",
)
def preprocess_corpus(spark, sf_dir):
    docs = t.arabic_docs(spark, sf_dir).withColumn("category", F.col("lang"))
    return preprocess(docs, order=["subset", "doc_id"]).select("doc_id", "subset", "processed_text")


@query("filter_class", "SELECT doc_id, quality FROM labels WHERE quality = 1")
def filter_class(spark, sf_dir):
    return reshape.filter_class(t.table(spark, sf_dir, "labels").select("doc_id", "quality"), 1, "quality")


@query("text_preview", "SELECT doc_id, substr(text, 1, 100) AS text_preview FROM documents")
def text_preview(spark, sf_dir):
    return t.documents(spark, sf_dir).select("doc_id", reshape.text_preview("text").alias("text_preview"))


_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


@query(
    "schema_table",
    " UNION ALL ".join(
        f"""SELECT {i} AS position, '{c}' AS column_name, CASE typeof(any_value({c})) WHEN 'VARCHAR' THEN 'string' ELSE
            lower(typeof(any_value({c}))) END AS data_type, count({c}) AS n_known, count(DISTINCT {c}) AS n_distinct FROM documents"""
        for i, c in enumerate(_COLUMNS)
    ),
)
def schema_table(spark, sf_dir):
    return reshape.column_table(t.table(spark, sf_dir, "documents").select(*_COLUMNS))


@query("preview", "SELECT doc_id, lang, text FROM documents ORDER BY doc_id LIMIT 3")
def preview(spark, sf_dir):
    return reshape.preview(t.table(spark, sf_dir, "documents"), ["doc_id", "lang", "text"], "doc_id")


# ---- summaries ------------------------------------------------------------------------------


@query("class_distribution", f"WITH {q.LATIN_DOCS} SELECT category_encode, count(*) AS n FROM docs GROUP BY 1")
def class_distribution(spark, sf_dir):
    return summaries.class_distribution(t.latin_docs(spark, sf_dir))


@query("subset_distribution", f"WITH {q.LATIN_DOCS} SELECT subset, category_encode, count(*) AS n FROM docs GROUP BY 1, 2 ORDER BY 1, 2")
def subset_distribution(spark, sf_dir):
    return summaries.subset_distribution(t.latin_docs(spark, sf_dir))


@query(
    "subset_class_pivot",
    f"""WITH {q.LATIN_DOCS} SELECT subset, count(*) FILTER (WHERE category_encode = 0) AS n_generated,
        count(*) FILTER (WHERE category_encode = 1) AS n_human FROM docs GROUP BY 1""",
)
def subset_class_pivot(spark, sf_dir):
    return summaries.subset_class_pivot(t.latin_docs(spark, sf_dir))


@query(
    "class_share",
    f"""WITH {q.LATIN_DOCS} SELECT category_encode, count(*) AS n, round(count(*) * 100.0 / sum(count(*)) OVER (), 6)::DOUBLE AS percent
        FROM docs GROUP BY 1""",
)
def class_share(spark, sf_dir):
    shares = summaries.class_share(t.latin_docs(spark, sf_dir))
    return shares.select("category_encode", "n", F.round(F.col("percent").cast("double"), 6).alias("percent"))


_SUMMARY_COLS = ["short_words_ratio", "total_physical_lines", "foreign_letters_count", "foreign_letters_ratio", "active_voice_count", "redundancy_score"]
_LONG = " UNION ALL ".join(
    f"SELECT category_encode, '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM styled" for c in _SUMMARY_COLS
)


@query(
    "feature_summary",
    f"""WITH {q.LATIN_STYLE}, long AS ({_LONG}) SELECT feature, count(value) AS n, round(avg(value), 6) AS mean,
        round(stddev_samp(value), 6) AS stddev, round(min(value), 6) AS min, round(max(value), 6) AS max FROM long GROUP BY 1""",
)
def feature_summary(spark, sf_dir):
    table = summaries.feature_summary(t.styled(spark, sf_dir), _SUMMARY_COLS)
    return table.select("feature", "n", *(_six(c) for c in ("mean", "stddev", "min", "max")))


_MEANS = ", ".join(f"round(avg({c}), {d}) AS {name}" for c, name, d in summaries.CLASS_MEANS)


@query("feature_means_by_class", f"WITH {q.LATIN_STYLE} SELECT category_encode, {_MEANS}, count(*) AS n_samples FROM styled GROUP BY 1")
def feature_means_by_class(spark, sf_dir):
    return summaries.feature_means_by_class(t.styled(spark, sf_dir))


_QUARTILES = ", ".join(f"round(quantile_cont(value, {p}), 6) AS {n}" for p, n in ((0.25, "q1"), (0.5, "q2"), (0.75, "q3")))


@query(
    "feature_quartiles",
    f"""WITH {q.LATIN_STYLE}, long AS ({_LONG}) SELECT category_encode, feature, {_QUARTILES} FROM long
        WHERE category_encode IS NOT NULL AND feature IN ('short_words_ratio', 'total_physical_lines', 'foreign_letters_count')
        GROUP BY 1, 2""",
)
def feature_quartiles(spark, sf_dir):
    table = summaries.feature_quartiles_by_class(t.styled(spark, sf_dir))
    return table.select("category_encode", "feature", *(_six(c) for c in ("q1", "q2", "q3")))


@query(
    "class_shift",
    f"""WITH {q.LATIN_STYLE}, long AS ({_LONG}), means AS (SELECT feature, avg(value) FILTER (WHERE category_encode = 1) AS h,
            avg(value) FILTER (WHERE category_encode = 0) AS g FROM long GROUP BY 1)
        SELECT feature, round(h, 6) AS mean_human, round(g, 6) AS mean_generated,
            round((g - h) / nullif(h, 0) * 100, 6) AS change_percent FROM means""",
)
def class_shift(spark, sf_dir):
    table = summaries.class_shift(t.styled(spark, sf_dir), _SUMMARY_COLS)
    return table.select("feature", *(_six(c) for c in ("mean_human", "mean_generated", "change_percent")))


_TTR = f"""{q.PROCESSED}, _t AS (SELECT doc_id, category_encode, {q.tokens('processed_text')} AS ts FROM processed),
    ttr AS (SELECT doc_id, category_encode, len(list_distinct(ts)) AS u, len(ts) AS n,
        {q.ratio('len(list_distinct(ts))', 'len(ts)')} AS doc_ttr FROM _t)"""


@query(
    "ttr_by_class",
    f"""WITH {_TTR} SELECT category_encode, round(avg(doc_ttr), 6) AS ttr_doc_mean, sum(u)::BIGINT AS total_unique,
        sum(n)::BIGINT AS total_tokens, count(*) AS n_docs, round(sum(u) / sum(n), 6) AS ttr_pooled FROM ttr GROUP BY 1""",
)
def ttr_by_class(spark, sf_dir):
    table = summaries.ttr_by_class(ttr_columns(t.processed(spark, sf_dir)))
    return table.select("category_encode", _six("ttr_doc_mean"), "total_unique", "total_tokens", "n_docs", _six("ttr_pooled"))


@query(
    "ttr_histogram",
    f"""WITH {_TTR}, v AS (SELECT category_encode, CAST(doc_ttr AS DOUBLE) AS v FROM ttr),
        r AS (SELECT *, min(v) OVER (PARTITION BY category_encode) AS lo, max(v) OVER (PARTITION BY category_encode) AS hi FROM v),
        b AS (SELECT category_encode, lo, hi, least(floor((v - lo) / (hi - lo) * 40), 39)::INT AS bin FROM r)
        SELECT category_encode, bin, round(lo + (hi - lo) / 40 * bin, 6) AS bin_start, count(*) AS n FROM b GROUP BY ALL""",
)
def ttr_histogram(spark, sf_dir):
    table = summaries.ttr_histogram(ttr_columns(t.processed(spark, sf_dir)))
    return table.select("category_encode", "bin", _six("bin_start"), "n")


# ---- corpus statistics ----------------------------------------------------------------------


@query("term_counts", f"WITH {_ARABIC_TERMS} SELECT kind, term, count(*) AS n FROM terms GROUP BY 1, 2")
def term_counts(spark, sf_dir):
    return corpus.term_counts(corpus.explode_terms(t.processed(spark, sf_dir)))


@query(
    "term_counts_original_adjacency",
    f"""WITH {q.PROCESSED}, tk AS (SELECT {q.script_tokens('processed_text', q.ARABIC)} AS ts FROM processed),
        terms AS (SELECT 'WORD' AS kind, unnest(list_filter(ts, lambda x: length(x) > 1)) AS term FROM tk
            UNION ALL SELECT 'BIGRAM', unnest({q.long_pairs('ts', '_')}) FROM tk)
        SELECT kind, term, count(*) AS n FROM terms GROUP BY 1, 2""",
)
def term_counts_original(spark, sf_dir):
    return corpus.term_counts(corpus.explode_terms(t.processed(spark, sf_dir), adjacency="original"))


@query("term_counts_by_class", f"WITH {_CLASS_COUNTS} SELECT kind, class, term, n FROM counts")
def term_counts_by_class(spark, sf_dir):
    return _counts(spark, sf_dir).select("kind", "class", "term", "n")


@query(
    "merge_counts",
    f"""WITH {_ARABIC_TERMS} SELECT kind AS type, term AS key, count(*) AS count FROM terms GROUP BY 1, 2""",
)
def merge_counts(spark, sf_dir):
    parts = corpus.explode_terms(t.processed(spark, sf_dir), keep=("subset",)).groupBy("subset", "kind", "term")
    rows = parts.agg(F.count(F.lit(1)).alias("count"))
    return corpus.merge_counts(rows.select(F.col("kind").alias("type"), F.col("term").alias("key"), "count"))


_STATS = f"""{_CLASS_COUNTS}, sums AS (SELECT class,
        coalesce(sum(n) FILTER (WHERE kind = 'WORD'), 0)::BIGINT AS total_tokens,
        count(*) FILTER (WHERE kind = 'WORD') AS unique_words,
        count(*) FILTER (WHERE kind = 'WORD' AND n = 1) AS hapax_count,
        count(*) FILTER (WHERE kind = 'WORD' AND n = 2) AS dislegomena_count,
        coalesce(sum(n) FILTER (WHERE kind = 'BIGRAM'), 0)::BIGINT AS total_bigrams,
        count(*) FILTER (WHERE kind = 'BIGRAM') AS unique_bigrams FROM counts GROUP BY class),
    stats AS (SELECT *, unique_words / total_tokens AS ttr_corpus, hapax_count / unique_words AS hapax_ratio,
        dislegomena_count / unique_words AS dislegomena_ratio FROM sums)"""


@query(
    "lexical_stats",
    f"""WITH {_STATS} SELECT * REPLACE (round(ttr_corpus, 6) AS ttr_corpus, round(hapax_ratio, 6) AS hapax_ratio,
        round(dislegomena_ratio, 6) AS dislegomena_ratio) FROM stats""",
)
def lexical_stats(spark, sf_dir):
    stats = corpus.lexical_stats(_counts(spark, sf_dir))
    ratios = ("ttr_corpus", "hapax_ratio", "dislegomena_ratio")
    return stats.withColumns({c: F.round(c, 6) for c in ratios})


def _top_sql(kind, n):
    return f"""WITH {_CLASS_COUNTS}, ranked AS (SELECT kind, term, class, n,
            row_number() OVER (PARTITION BY class ORDER BY n DESC, term) AS rank FROM counts WHERE kind = '{kind}')
        SELECT * FROM ranked WHERE rank <= {n}"""


@query("top_words_by_class", _top_sql("WORD", 20))
def top_words_by_class(spark, sf_dir):
    return corpus.top_terms(_counts(spark, sf_dir), corpus.WORD)


@query("top_bigrams_by_class", _top_sql("BIGRAM", 20))
def top_bigrams_by_class(spark, sf_dir):
    return corpus.top_terms(_counts(spark, sf_dir), corpus.BIGRAM)


@query("top_words_deep", _top_sql("WORD", 1500))
def top_words_deep(spark, sf_dir):
    return corpus.top_terms(_counts(spark, sf_dir), corpus.WORD, 1500)


@query(
    "top_ws_bigrams",
    f"""WITH {q.PROCESSED}, tk AS (SELECT {q.tokens('processed_text')} AS ts FROM processed),
        pairs AS (SELECT unnest({q.long_pairs('ts', ' ')}) AS term FROM tk)
        SELECT term, count(*) AS n FROM pairs GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20""",
)
def top_ws_bigrams(spark, sf_dir):
    counts = corpus.term_counts(corpus.explode_ws_terms(t.processed(spark, sf_dir)))
    pairs = counts.filter(F.col("kind") == corpus.BIGRAM)
    return pairs.orderBy(F.desc("n"), F.asc("term")).limit(20).select("term", "n")


@query(
    "cloud_weights",
    f"""{_top_sql('WORD', 200).replace('SELECT * FROM ranked', "SELECT kind, term, class, n, rank, round(n / max(n) OVER (PARTITION BY class), 6) AS weight FROM ranked")}""",
)
def cloud_weights(spark, sf_dir):
    return corpus.cloud_weights(_counts(spark, sf_dir)).withColumn("weight", F.round("weight", 6))


@query("type_inventory", f"WITH {_CLASS_COUNTS} SELECT kind, class, count(*) AS distinct_terms, sum(n)::BIGINT AS occurrences FROM counts GROUP BY 1, 2")
def type_inventory(spark, sf_dir):
    return corpus.type_inventory(_counts(spark, sf_dir))


_STAT_LONG = " UNION ALL ".join(f"SELECT class, '{c}' AS stat, CAST({c} AS DOUBLE) AS value FROM stats" for c in corpus.RATIO_STATS)


@query(
    "stat_ratios",
    f"""WITH {_STATS}, long AS ({_STAT_LONG}), p AS (SELECT stat, max(value) FILTER (WHERE class = 'HUMAN') AS human,
            max(value) FILTER (WHERE class = 'AI') AS ai FROM long GROUP BY stat)
        SELECT stat, round(human, 6) AS human, round(ai, 6) AS ai, round(ai / nullif(human, 0), 6) AS ai_to_human FROM p""",
)
def stat_ratios(spark, sf_dir):
    table = corpus.stat_ratios(corpus.lexical_stats(_counts(spark, sf_dir)))
    return table.select("stat", _six("human"), _six("ai"), _six("ai_to_human"))


# ---- joins and contrast ---------------------------------------------------------------------


@query(
    "distinctive_bigrams",
    f"""WITH {_CLASS_COUNTS}, sizes AS (SELECT count(*) FILTER (WHERE category_encode = 0) AS a,
            count(*) FILTER (WHERE category_encode = 1) AS h FROM docs),
        top AS (SELECT * FROM wide WHERE kind = 'BIGRAM' AND n_ai > 0 ORDER BY n_ai DESC, term LIMIT 500)
        SELECT term, n_human, n_ai, round((n_ai / a) / ((n_human + 1) / (h + 1)), 6) AS ratio FROM top, sizes
        WHERE n_ai >= 5 ORDER BY (n_ai / a) / ((n_human + 1) / (h + 1)) DESC, term LIMIT 15""",
)
def distinctive_bigrams(spark, sf_dir):
    docs = t.processed(spark, sf_dir)
    wide = corpus.term_counts_wide(corpus.explode_terms(docs, keep=("category_encode",)))
    sizes = summaries.class_distribution(docs)
    return corpus.distinctive_terms(wide, sizes, min_count=5).withColumn("ratio", F.round("ratio", 6))


@query("attach_labels", "SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id")
def attach_labels(spark, sf_dir):
    docs = t.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return labels.attach_labels(docs, t.table(spark, sf_dir, "labels"))


@query("unlabelled_docs", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def unlabelled_docs(spark, sf_dir):
    return labels.unlabelled(t.table(spark, sf_dir, "documents").select("doc_id", "lang"), t.table(spark, sf_dir, "labels"))


@query(
    "stopword_anti_join",
    f"""WITH tk AS (SELECT doc_id, unnest({q.tokens('text')}) AS token FROM documents)
        SELECT doc_id, token, count(*) AS n FROM tk WHERE token NOT IN ({q.quoted(LATIN.stopwords)}) GROUP BY 1, 2""",
)
def stopword_anti_join(spark, sf_dir):
    stop = spark.createDataFrame([(w,) for w in LATIN.stopwords], "token string")
    tokens = t.documents(spark, sf_dir).select("doc_id", F.explode(tokenize_ws("text")).alias("token"))
    return labels.stopword_anti_join(tokens, stop).groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))


# ---- reports from stored counts -------------------------------------------------------------


@query(
    "corpus_report",
    f"""WITH {_STATS}, ranked AS (SELECT kind, class, term, n, row_number() OVER (PARTITION BY kind, class ORDER BY n DESC, term) AS rank FROM counts)
        SELECT 'top' AS part, kind || ' ' || class || ' ' || term AS name, n::DOUBLE AS value FROM ranked WHERE rank <= 20
        UNION ALL SELECT 'tokens', class, total_tokens::DOUBLE FROM stats
        UNION ALL SELECT 'hapax', class, round(hapax_ratio, 6) FROM stats""",
)
def corpus_report(spark, sf_dir):
    report = reports.corpus_report(t.processed(spark, sf_dir), scratch_dir(spark, "report"))
    top = report["top_words"].unionByName(report["top_bigrams"])
    name = F.concat_ws(" ", "kind", "class", "term")
    rows = [top.select(F.lit("top").alias("part"), name.alias("name"), F.col("n").cast("double").alias("value"))]
    for part, column in (("tokens", F.col("total_tokens").cast("double")), ("hapax", F.round("hapax_ratio", 6))):
        rows.append(report["stats"].select(F.lit(part).alias("part"), F.col("class").alias("name"), column.alias("value")))
    return reshape.union_subsets(rows)


@query(
    "explore_corpus",
    f"""WITH {_TTR} SELECT category_encode, round(avg(doc_ttr), 6) AS ttr_doc_mean, count(*) AS n_docs FROM ttr GROUP BY 1""",
)
def explore_corpus(spark, sf_dir):
    found = reports.explore(t.processed(spark, sf_dir), scratch_dir(spark, "explore"))
    return found["ttr"].select("category_encode", _six("ttr_doc_mean"), "n_docs")


_SKETCHED = ("short_words_ratio", "total_physical_lines", "foreign_letters_count")


@query(
    "sketched_quartiles",
    f"""WITH {q.LATIN_STYLE}, long AS ({_LONG}) SELECT DISTINCT category_encode, feature, prob::DOUBLE AS prob, TRUE AS within
        FROM long, (VALUES (0.25), (0.5), (0.75)) AS p(prob)
        WHERE category_encode IS NOT NULL AND value IS NOT NULL AND feature IN {_SKETCHED}""",
)
def sketched_quartiles(spark, sf_dir):
    """Sketches stored per subset and class, merged per class, against the exact ranks of what they give."""
    path = scratch_dir(spark, "sketches")
    docs = t.styled(spark, sf_dir).filter("category_encode IS NOT NULL").select("subset", "category_encode", *_SKETCHED)
    made = sketches.quantile_sketches(docs, ["subset", "category_encode"], list(_SKETCHED))
    found = sketches.merged_quantiles(stored(made, path), ["category_encode"])
    values = docs.unpivot(["category_encode"], list(_SKETCHED), "feature", "x").filter("x IS NOT NULL")
    joined = values.join(found, ["category_encode", "feature"])
    shares = joined.groupBy("category_encode", "feature", "prob").agg(
        F.avg((F.col("x") < F.col("value")).cast("int")).alias("below"), F.avg((F.col("x") <= F.col("value")).cast("int")).alias("up_to")
    )
    room = 3 * sketches.RANK_ERROR
    within = (F.col("below") - room <= F.col("prob")) & (F.col("prob") <= F.col("up_to") + room)
    return shares.select("category_encode", "feature", F.col("prob").cast("double"), within.alias("within"))


@query(
    "sketched_types",
    f"""WITH {_CLASS_COUNTS}, sides AS (SELECT kind, term, bool_or(class = 'HUMAN') AS h, bool_or(class = 'AI') AS g FROM counts GROUP BY 1, 2)
        SELECT kind, count(*) FILTER (h) AS n_human, count(*) FILTER (g) AS n_ai, count(*) FILTER (h OR g) AS n_both,
            count(*) FILTER (h AND g) AS n_shared, TRUE AS within FROM sides GROUP BY 1""",
)
def sketched_types(spark, sf_dir):
    """Distinct words and bigrams per class, in both and shared: exact numbers, and whether the merged sketches are within 5 % of n_both."""
    terms = stored(_terms(spark, sf_dir).select("kind", "term", "category_encode"), scratch_dir(spark, "terms"))
    made = sketches.type_sketches(terms.withColumn("part", F.pmod(F.xxhash64("term"), F.lit(7))), ["part", "kind", "category_encode"])
    guess = sketches.class_types(stored(made, scratch_dir(spark, "type-sketches")), ["kind"])
    human, ai = F.col("n_human") > 0, F.col("n_ai") > 0
    wide = corpus.term_counts_wide(terms)
    exact = wide.groupBy("kind").agg(
        *(F.count_if(c).alias(n) for n, c in (("n_human", human), ("n_ai", ai), ("n_both", human | ai), ("n_shared", human & ai)))
    )
    names = ("n_human", "n_ai", "n_both", "n_shared")
    joined = exact.join(guess.select("kind", *(F.col(n).alias(f"_{n}") for n in names)), "kind")
    near = [F.abs(F.col(n) - F.col(f"_{n}")) <= 0.05 * F.col("n_both") for n in names]
    return joined.select("kind", *names, (near[0] & near[1] & near[2] & near[3]).alias("within"))


@query("frequent_bigrams", _top_sql("BIGRAM", 20))
def frequent_bigrams(spark, sf_dir):
    """The rows of top_bigrams_by_class, from candidates of a sketch that are counted exactly."""
    docs = t.processed(spark, sf_dir).select("processed_text", "category_encode")
    texts = stored(docs, scratch_dir(spark, "processed"))  # read twice, and far smaller than its occurrences
    terms = corpus.explode_terms(texts, keep=("category_encode",)).filter(F.col("kind") == corpus.BIGRAM)
    top = sketches.frequent_terms(terms.select("term", "category_encode"))
    return top.select(F.lit(corpus.BIGRAM).alias("kind"), "class", "term", "n", "rank")


@query("merge_stored_counts", ORACLES["merge_counts"])
def merge_stored_counts(spark, sf_dir):
    """Counts of two increments, each stored as a bucketed table, merged bucket by bucket."""
    terms = corpus.explode_terms(t.processed(spark, sf_dir), keep=("subset",)).withColumn("late", F.crc32("subset") % 2)
    root, names = scratch_dir(spark, "increments"), []
    for late in (0, 1):
        counts = corpus.term_counts(terms.filter(F.coalesce("late", F.lit(0)) == late))
        names.append(f"increment_{late}_{root[-32:]}")
        rows = counts.select(F.col("kind").alias("type"), F.col("term").alias("key"), F.col("n").alias("count"))
        count_store.save_counts(rows, names[-1], buckets=8, path=f"{root}/{late}")
    return count_store.merge_stored(spark, names, 8, f"{root}/merged")


@query("term_counts_sql", ORACLES["term_counts"])
def term_counts_sql(spark, sf_dir):
    """The rows of term_counts by SQL alone: a table function called laterally."""
    register_table_functions(spark)
    t.processed(spark, sf_dir).createOrReplaceTempView("qm_processed")
    return spark.sql("SELECT kind, term, count(*) AS n FROM qm_processed, LATERAL qm_terms(processed_text) GROUP BY kind, term")


@query("clustered_range", "SELECT doc_id, lang, source, n_chars FROM documents WHERE n_chars BETWEEN 500 AND 2000")
def clustered_range(spark, sf_dir):
    """Documents of a range of lengths, read from files clustered by length."""
    path = scratch_dir(spark, "clustered")
    docs = t.table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    layout.write_clustered(docs, path, "n_chars", parts=16)
    return layout.read_between(spark, path, "n_chars", 500, 2000)

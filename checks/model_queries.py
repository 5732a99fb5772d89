"""Splits, feature vectors, classifiers, metrics and streams."""

from __future__ import annotations

from functools import cache

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import sql as q
from checks import tables as t
from checks.registry import query
from quillmark.functions import tokenize_lower
from quillmark.functions.stylometry import STYLO_COLUMNS
from quillmark.operators import evaluation, features, models, reshape, splits, tfidf
from quillmark.plans import training
from quillmark.plans.preparation import add_style
from quillmark.plans.training import build_features
from quillmark.profiles import LATIN
from quillmark.sources import artifacts, streams
from quillmark.sources.scratch import scratch_dir, stored
from quillmark.streaming import scoring

# ---- splits ---------------------------------------------------------------------------------

_SPLIT = f"""{q.LATIN_DOCS},
    h AS (SELECT *, CAST('0x' || substr(md5('42-' || doc_id), 1, 8) AS BIGINT) / 4294967296 AS h FROM docs),
    split AS (SELECT doc_id, category_encode, CASE WHEN h < 0.7 THEN 'train' WHEN h < 0.85 THEN 'val' ELSE 'test' END AS split
      FROM h WHERE category_encode IN (0, 1))"""


@query("stratified_split", f"WITH {_SPLIT} SELECT doc_id, category_encode, split FROM split")
def stratified_split(spark, sf_dir):
    docs = t.latin_docs(spark, sf_dir).select("doc_id", "category_encode")
    return splits.stratified_split(docs, "doc_id")


@query("split_sizes", f"WITH {_SPLIT} SELECT split, category_encode, count(*) AS n FROM split GROUP BY 1, 2")
def split_sizes(spark, sf_dir):
    return splits.split_sizes(stratified_split(spark, sf_dir))


@query(
    "exact_split",
    f"""WITH {_SPLIT}, r AS (SELECT doc_id, category_encode, row_number() OVER (PARTITION BY category_encode ORDER BY h, doc_id) - 1 AS place,
            count(*) OVER (PARTITION BY category_encode) AS size FROM h WHERE category_encode IN (0, 1))
        SELECT doc_id, category_encode, CASE WHEN place < round(size * 0.7) THEN 'train' WHEN place < round(size * 0.85) THEN 'val'
            ELSE 'test' END AS split FROM r""",
)
def exact_split(spark, sf_dir):
    docs = t.latin_docs(spark, sf_dir).select("doc_id", "category_encode")
    return splits.exact_split(docs, "doc_id")


# ---- TF-IDF ---------------------------------------------------------------------------------

_TOKENS = f"t AS (SELECT doc_id, {q.tokens('lower(text)')} AS ts FROM documents), w AS (SELECT doc_id, unnest(ts) AS term FROM t)"


def _tokens(spark, sf_dir) -> DataFrame:
    return t.documents(spark, sf_dir).select("doc_id", tokenize_lower("text").alias("tokens"))


@query("document_frequency", f"WITH {_TOKENS} SELECT term, count(DISTINCT doc_id) AS df FROM w GROUP BY 1")
def document_frequency(spark, sf_dir):
    return tfidf.document_frequency(_tokens(spark, sf_dir))


@query(
    "tfidf_terms",
    f"""WITH {_TOKENS}, tf AS (SELECT doc_id, term, count(*) AS tf FROM w GROUP BY 1, 2),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1), m AS (SELECT count(*) AS m FROM documents),
        i AS (SELECT doc_id, term, tf, df, CASE WHEN df >= 2 THEN ln((m + 1) / (df + 1)) ELSE 0 END AS idf
          FROM tf JOIN df USING (term), m)
        SELECT doc_id, term, tf, df, round(idf, 6) AS idf, round(tf * idf, 6) AS weight FROM i""",
)
def tfidf_terms(spark, sf_dir):
    table = tfidf.tf_idf_table(_tokens(spark, sf_dir), "doc_id")
    return table.withColumns({c: F.round(c, 6) for c in ("idf", "weight")})


_total = lambda vector: F.aggregate(vector_to_array(vector), F.lit(0.0), lambda a, b: a + b)


def _buckets(terms: DataFrame) -> DataFrame:
    """``(term, bucket)``: where the hashed vectors put each distinct term, found one term at a time."""
    one = terms.select("term").distinct().withColumn("tokens", F.array("term"))
    vectors = features.term_frequency().transform(one)
    return vectors.select("term", (F.array_position(vector_to_array("raw_tf"), 1.0) - 1).cast("int").alias("bucket"))


def _entries(vectors: DataFrame, column: str) -> DataFrame:
    """``(doc_id, bucket, value)`` of the entries other than 0."""
    v = F.unwrap_udt(column)  # a dense vector has no indices
    places = F.coalesce(v["indices"], F.sequence(F.lit(0), F.size(v["values"]) - 1))
    each = vectors.select("doc_id", F.explode(F.arrays_zip(places.alias("bucket"), v["values"].alias("value"))).alias("e"))
    return each.select("doc_id", "e.*").filter("value <> 0")


def _same_entries(docs: DataFrame, got: DataFrame, wanted: DataFrame) -> DataFrame:
    """``docs`` with ``same``: all entries of a document's vector are as wanted within 1e-9."""
    both = got.withColumnRenamed("value", "a").join(wanted.withColumnRenamed("value", "b"), ["doc_id", "bucket"], "full")
    off = F.abs(F.coalesce("a", F.lit(0.0)) - F.coalesce("b", F.lit(0.0))) > 1e-9
    wrong = both.groupBy("doc_id").agg(F.count_if(off).alias("wrong"))
    return docs.join(wrong, "doc_id", "left").withColumn("same", F.coalesce("wrong", F.lit(0)) == 0).drop("wrong")


def _explicit_tf(tokens: DataFrame) -> DataFrame:
    """Counts of explicit terms, folded into their buckets."""
    counts = tfidf.term_frequencies(tokens, "doc_id")
    return counts.join(_buckets(counts), "term").groupBy("doc_id", "bucket").agg(F.sum("tf").cast("double").alias("value"))


@query("hashing_tf", f"WITH {_TOKENS} SELECT doc_id, len(ts)::DOUBLE AS total_tf, 10000 AS dims, TRUE AS same FROM t")
def hashing_tf(spark, sf_dir):
    """Hashed counts, each entry compared with explicit counts."""
    tokens = _tokens(spark, sf_dir)
    vectors = features.term_frequency().transform(tokens)
    docs = vectors.select("doc_id", _total("raw_tf").alias("total_tf"), F.size(vector_to_array("raw_tf")).alias("dims"))
    return _same_entries(docs, _entries(vectors, "raw_tf"), _explicit_tf(tokens))


@query("tfidf_vectors", f"WITH {_SPLIT} SELECT doc_id, split, TRUE AS same FROM split")
def tfidf_vectors(spark, sf_dir):
    """Hashed TF-IDF weights, each entry compared with explicit counts times ln((m + 1) / (df + 1)) of the training rows."""
    rows = spark.read.parquet(_features(spark, sf_dir).path)
    texts = rows.select("doc_id", "split", F.array_remove(F.split(F.lower("processed_text"), r"\s+"), "").alias("tokens"))
    tf = _explicit_tf(texts)
    training = texts.filter("split = 'train'").select("doc_id")
    m = training.agg(F.count(F.lit(1))).scalar()
    df = tf.join(training, "doc_id").groupBy("bucket").agg(F.count(F.lit(1)).alias("df"))
    idf = F.when(F.col("df") >= features.MIN_DOC_FREQ, F.log((m + 1) / (F.col("df") + 1))).otherwise(0.0)
    wanted = tf.join(df, "bucket").select("doc_id", "bucket", (F.col("value") * idf).alias("value"))
    return _same_entries(rows.select("doc_id", "split"), _entries(rows, "tfidf_features"), wanted)


@query(
    "feature_vectors",
    f"""WITH {q.LATIN_STYLE} SELECT doc_id, category_encode, 8 AS stylo_dims, 10008 AS dims, TRUE AS same,
        {", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in STYLO_COLUMNS)} FROM styled WHERE category_encode IN (0, 1)""",
)
def feature_vectors(spark, sf_dir):
    """Every style entry by name, and whether the full vector is style and TF-IDF in this order."""
    rows = spark.read.parquet(_features(spark, sf_dir).path)
    style, full = vector_to_array("features_stylo"), vector_to_array("features")
    return rows.select(
        "doc_id",
        "category_encode",
        F.size(style).alias("stylo_dims"),
        F.size(full).alias("dims"),
        (full == F.concat(style, vector_to_array("tfidf_features"))).alias("same"),
        *(F.round(style[i], 6).alias(c) for i, c in enumerate(STYLO_COLUMNS)),
    )


# ---- classifiers ----------------------------------------------------------------------------


@cache
def _features(spark, sf_dir):
    """Feature tables of the labelled documents, built once per session and scale."""
    docs = add_style(t.latin_docs(spark, sf_dir).filter("category_encode IS NOT NULL"), LATIN, deal=True)
    return build_features(docs, scratch_dir(spark, "features"), "doc_id", keep=("doc_id",))


@cache
def _trained(spark, sf_dir, name, column=models.FEATURES):
    """A classifier with default parameters and its seconds, fitted once per session and scale."""
    return models.train(name, _features(spark, sf_dir).split("train"), column)


def _classifier(spark, sf_dir, name, column=models.FEATURES):
    return _trained(spark, sf_dir, name, column)[0]


def _held_out(spark, sf_dir) -> DataFrame:
    tables = _features(spark, sf_dir)
    return reshape.union_subsets([tables.split(s).withColumn("split", F.lit(s)) for s in ("val", "test")])


_HELD_OUT = f"WITH {_SPLIT} SELECT doc_id, split, category_encode, TRUE AS {{flag}} FROM split WHERE split <> 'train'"


def _score_linear(name, column):
    @query(name, _HELD_OUT.format(flag="is_logistic"))
    def run(spark, sf_dir):
        """Each score against the logistic function of the fitted coefficients, summed entry by entry."""
        model, rows = _classifier(spark, sf_dir, "LogisticRegression", column), _held_out(spark, sf_dir)
        weights = [(i, w) for i, w in enumerate(model.coefficients.toArray().tolist())]
        table = spark.createDataFrame(weights, "bucket int, weight double")
        margin = _entries(rows, column).join(table, "bucket").groupBy("doc_id").agg(F.sum(F.col("value") * F.col("weight")).alias("m"))
        scored = models.score(model, rows).select("doc_id", "split", "category_encode", "score").join(margin, "doc_id", "left")
        logistic = 1 / (1 + F.exp(-(F.coalesce("m", F.lit(0.0)) + F.lit(float(model.intercept)))))
        return scored.select("doc_id", "split", "category_encode", (F.abs(F.col("score") - logistic) < 1e-9).alias("is_logistic"))


def _score_trees(name, classifier):
    @query(name, _HELD_OUT.format(flag="is_same_and_larger"))
    def run(spark, sf_dir):
        """Each prediction is the class of the larger probability, and the reloaded model gives the same."""
        model, rows = _classifier(spark, sf_dir, classifier), _held_out(spark, sf_dir)
        path = scratch_dir(spark, name)
        artifacts.save_model(PipelineModel(stages=[model]), path)
        first = models.score(model, rows).select("doc_id", "split", "category_encode", "prediction", "score")
        again = models.score(artifacts.load_model(path), rows).select("doc_id", F.col("prediction").alias("p2"), F.col("score").alias("s2"))
        larger = F.col("prediction") == F.when(F.col("score") > 0.5, 1.0).otherwise(0.0)
        same = (F.col("prediction") == F.col("p2")) & (F.abs(F.col("score") - F.col("s2")) < 1e-12)
        return first.join(again, "doc_id").select("doc_id", "split", "category_encode", (larger & same).alias("is_same_and_larger"))


_score_linear("score_lr", models.FEATURES)
_score_trees("score_rf", "RandomForest")
_score_trees("score_gbt", "GBTClassifier")
_score_linear("score_stylo", models.STYLO_FEATURES)


@query(
    "training_report",
    f"""WITH {_SPLIT}, m AS (SELECT * FROM (VALUES ('GBTClassifier'), ('LogisticRegression'), ('RandomForest')) AS x(model))
        SELECT model, split, count(*) AS n, count(*) FILTER (WHERE category_encode = 1) AS n_human, TRUE AS accuracy_fits,
            TRUE AS timed, TRUE AS saved FROM split, m WHERE split <> 'train' GROUP BY 1, 2""",
)
def training_report(spark, sf_dir):
    """All models trained, evaluated and saved: stored confusion matrices against split sizes and metrics."""
    tables = _features(spark, sf_dir)
    fitted, metrics = training.train_all(tables, trained={name: _trained(spark, sf_dir, name, models.FEATURES) for name in models.CLASSIFIERS})
    path = scratch_dir(spark, "models")
    training.save_all(tables, fitted, metrics, path)
    report = training.evaluation_report(tables)
    of = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    cells = report["confusion"].groupBy("model", "split").agg(
        F.sum("n").alias("n"), of(F.col("label") == 1).alias("n_human"), of(F.col("label") == F.col("prediction")).alias("right")
    )
    accuracy = spark.read.json(f"{path}/report/metrics").filter("metric = 'accuracy'").select("model", "split", "value")
    times = metrics.filter("metric = 'train_time_s'").select("model", (F.col("value") > 0).alias("timed"))
    saved = [(name, isinstance(artifacts.load_model(f"{path}/{name}").stages[-1], type(model))) for name, model in fitted.items()]
    joined = cells.join(accuracy, ["model", "split"]).join(times, "model").join(spark.createDataFrame(saved, "model string, saved boolean"), "model")
    fits = F.abs(F.col("value") - F.col("right") / F.col("n")) < 1e-9
    return joined.select("model", "split", "n", "n_human", fits.alias("accuracy_fits"), "timed", "saved")


def _pipeline(spark, sf_dir):
    return models.scoring_pipeline(_features(spark, sf_dir).model, _classifier(spark, sf_dir, "LogisticRegression"))


_VIEW = """SELECT substr(text, 1, 100) AS text_preview, {label}, round(CAST(short_words_ratio AS DOUBLE), 6) AS short_words_ratio,
    total_physical_lines, foreign_letters_count FROM styled"""


def _known(view: DataFrame) -> DataFrame:
    """The output columns that do not depend on the fitted model or the clock."""
    ratio = F.round(F.col("short_words_ratio").cast("double"), 6).alias("short_words_ratio")
    return view.select("text_preview", "true_label", ratio, "total_physical_lines", "foreign_letters_count")


@query("prediction_view", f"WITH {q.LATIN_STYLE} {_VIEW.format(label='category_encode AS true_label')}")
def prediction_view(spark, sf_dir):
    docs = t.styled(spark, sf_dir)
    return _known(reshape.prediction_view(_pipeline(spark, sf_dir).transform(docs), "category_encode"))


def _styled_once(spark, sf_dir) -> DataFrame:
    """What a pipeline reads of every document, stored: the measures behind the features and those of all other documents."""
    known = _features(spark, sf_dir).measures()
    others = t.latin_docs(spark, sf_dir).filter(~F.coalesce(F.col("category_encode").isin(0, 1), F.lit(False)))
    columns = ["doc_id", "processed_text", *STYLO_COLUMNS]
    rest = stored(add_style(others, LATIN, deal=True).select(*columns), scratch_dir(spark, "styled"))
    return known.select(*columns).unionByName(rest)


@query("model_roundtrip", "SELECT doc_id, TRUE AS same FROM documents")
def model_roundtrip(spark, sf_dir):
    path, model = scratch_dir(spark, "model"), _pipeline(spark, sf_dir)
    artifacts.save_model(model, path)
    docs = _styled_once(spark, sf_dir)
    both = (models.score(m, docs).select("doc_id", F.struct("prediction", "score").alias(n)) for m, n in ((model, "a"), (artifacts.load_model(path), "b")))
    first, second = both
    return first.join(second, "doc_id", "full").select("doc_id", F.col("a").eqNullSafe(F.col("b")).alias("same"))


# ---- metrics, on scores that both engines derive from the id --------------------------------


@query("correct_predictions", f"WITH {q.SCORED} SELECT count(*) AS n, count(*) FILTER (WHERE prediction = category_encode) AS n_correct FROM predicted")
def correct_predictions(spark, sf_dir):
    return evaluation.correct_predictions(t.scored(spark, sf_dir))


_GRID = """grid AS (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) AS g(label, prediction)),
    confusion AS (SELECT g.label, g.prediction, count(p.doc_id) AS n FROM grid g
        LEFT JOIN predicted p ON p.category_encode = g.label AND p.prediction = g.prediction GROUP BY 1, 2)"""


@query("confusion_matrix", f"WITH {q.SCORED}, {_GRID} SELECT * FROM confusion")
def confusion_matrix(spark, sf_dir):
    return evaluation.confusion_matrix(t.scored(spark, sf_dir))


def _per_class(source: str, keys: str = "") -> str:
    """Per-class metrics from predictions, by counting rather than from a matrix."""
    return f"""per_class AS (SELECT {keys} class, count(*) FILTER (WHERE category_encode = class) AS support,
        count(*) FILTER (WHERE prediction = class) AS predicted,
        count(*) FILTER (WHERE category_encode = class AND prediction = class) AS correct
      FROM {source}, (VALUES (0), (1)) AS c(class) GROUP BY {keys} class),
    rated AS (SELECT *, correct / nullif(predicted, 0) AS precision, correct / nullif(support, 0) AS recall,
        coalesce(2 * correct / nullif(support + predicted, 0), 0) AS f1 FROM per_class)"""


@query(
    "per_class_metrics",
    f"""WITH {q.SCORED}, {_per_class('predicted')} SELECT class, support, predicted, correct, round(precision, 6) AS precision,
        round(recall, 6) AS recall, round(f1, 6) AS f1 FROM rated""",
)
def per_class_metrics(spark, sf_dir):
    table = evaluation.per_class_metrics(evaluation.confusion_matrix(t.scored(spark, sf_dir)))
    return table.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1")})


def _weighted(keys: str = "") -> str:
    return f"""weighted AS (SELECT {keys} sum(correct) / sum(support) AS accuracy,
        sum(coalesce(precision, 0) * support) / sum(support) AS precision, sum(coalesce(recall, 0) * support) / sum(support) AS recall,
        sum(f1 * support) / sum(support) AS f1, avg(f1) AS macro_f1 FROM rated {'GROUP BY ' + keys.rstrip(', ') if keys else ''})"""


@query(
    "weighted_metrics",
    f"""WITH {q.SCORED}, {_per_class('predicted')}, {_weighted()} SELECT round(accuracy, 6) AS accuracy,
        round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, round(macro_f1, 6) AS macro_f1 FROM weighted""",
)
def weighted_metrics(spark, sf_dir):
    table = evaluation.weighted_metrics(evaluation.confusion_matrix(t.scored(spark, sf_dir)))
    return table.select(*(F.round(c, 6).alias(c) for c in table.columns))


def _auc(source: str, keys: str = "") -> str:
    """AUC by ranks, ties at their average rank."""
    by = keys.rstrip(", ")
    part = f"PARTITION BY {by}" if by else ""
    same = f"PARTITION BY {keys} score"
    return f"""ranked AS (SELECT *, row_number() OVER ({part} ORDER BY score) AS r FROM {source}),
    tied AS (SELECT *, avg(r) OVER ({same}) AS rank FROM ranked),
    sums AS (SELECT {keys} sum(rank) FILTER (WHERE category_encode = 1) AS s, count(*) FILTER (WHERE category_encode = 1) AS p,
        count(*) FILTER (WHERE category_encode = 0) AS n FROM tied {'GROUP BY ' + by if by else ''}),
    auc AS (SELECT {keys} (s - p * (p + 1) / 2) / (p * n) AS roc_auc FROM sums)"""


@query("roc_auc", f"WITH {q.SCORED}, {_auc('scored')} SELECT round(roc_auc, 6) AS roc_auc FROM auc")
def roc_auc(spark, sf_dir):
    return evaluation.roc_auc(t.scored(spark, sf_dir)).select(F.round("roc_auc", 6).alias("roc_auc"))


@query(
    "roc_points",
    f"""WITH {q.SCORED}, d AS (SELECT DISTINCT score FROM scored)
        SELECT d.score AS threshold,
            round(count(*) FILTER (WHERE s.score >= d.score AND category_encode = 0) / count(*) FILTER (WHERE category_encode = 0), 6) AS fpr,
            round(count(*) FILTER (WHERE s.score >= d.score AND category_encode = 1) / count(*) FILTER (WHERE category_encode = 1), 6) AS tpr
        FROM d, scored s GROUP BY 1""",
)
def roc_points(spark, sf_dir):
    return evaluation.roc_curve(t.scored(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in ("fpr", "tpr")})


_KEYS = "model, split, "
_METRICS = f"""{q.RUNS}, {_per_class('predicted', _KEYS)}, {_weighted(_KEYS)}, {_auc('runs', _KEYS)},
    joined AS (SELECT * FROM weighted JOIN auc USING (model, split)),
    metrics AS ({' UNION ALL '.join(f"SELECT model, split, '{m}' AS metric, {m} AS value FROM joined" for m in evaluation.METRICS)})"""


def _metrics(spark, sf_dir):
    return evaluation.metrics_table(t.runs(spark, sf_dir))


@query("metrics_table", f"WITH {_METRICS} SELECT model, split, metric, round(value, 6) AS value FROM metrics")
def metrics_table(spark, sf_dir):
    return _metrics(spark, sf_dir).withColumn("value", F.round("value", 6))


@query(
    "choose_model",
    f"""WITH {_METRICS} SELECT model, round(value, 6) AS f1 FROM metrics WHERE metric = 'f1' AND split = 'val'
        ORDER BY value DESC, model LIMIT 1""",
)
def choose_model(spark, sf_dir):
    return evaluation.choose_model(_metrics(spark, sf_dir)).withColumn("f1", F.round("f1", 6))


@query(
    "model_comparison",
    f"""WITH {_METRICS} SELECT model, round(max(value) FILTER (WHERE metric = 'accuracy'), 6) AS accuracy,
        round(max(value) FILTER (WHERE metric = 'f1'), 6) AS f1, round(max(value) FILTER (WHERE metric = 'roc_auc'), 6) AS roc_auc,
        any_value(t.seconds) AS train_time_s
        FROM metrics JOIN (SELECT model, round(sum(score), 6) AS seconds FROM runs WHERE split = 'val' GROUP BY 1) AS t USING (model)
        WHERE split = 'test' GROUP BY 1""",
)
def model_comparison(spark, sf_dir):
    """The times stand in for measured ones: a sum over the model's rows, which both engines can work out."""
    seconds = t.runs(spark, sf_dir).filter("split = 'val'").groupBy("model").agg(F.round(F.sum("score"), 6).alias("value"))
    times = seconds.select("model", F.lit("train").alias("split"), F.lit("train_time_s").alias("metric"), "value")
    table = evaluation.model_comparison(_metrics(spark, sf_dir).unionByName(times))
    return table.select("model", *(F.round(c, 6).alias(c) for c in ("accuracy", "f1", "roc_auc", "train_time_s")))


# ---- streams --------------------------------------------------------------------------------

_MESSAGES = f"""base AS (SELECT conv_id, turn, text, CASE role WHEN 'user' THEN 1 WHEN 'assistant' THEN 0 END AS true_label FROM conversations),
    {q.clean_ctes('base')}, {q.style_ctes(LATIN)}"""


def _drop(messages: DataFrame, path: str, files: int = 4) -> None:
    """Add messages to an incoming folder, as a producer would."""
    messages.select("text", "true_label").repartition(files, "text").write.mode("append").json(path)


def _run(spark, incoming: str, out: str, checkpoint: str, model, monitor=None, progress=None):
    stream = streams.stream_json_files(spark, incoming, max_files=1)
    scored = scoring.stream_score(stream, model, LATIN)
    return scoring.run_stream(scored, out, checkpoint, every=None, monitor=monitor, progress=progress)


@query(
    "stream_features",
    f"""WITH {_MESSAGES} SELECT text, true_label, cleaned_text, {q.normalized('cleaned_text', LATIN)} AS processed_text, {q.measures()} FROM styled""",
)
def stream_features(spark, sf_dir):
    root = scratch_dir(spark, "stream-features")
    _drop(t.messages(spark, sf_dir), f"{root}/in")
    stream = scoring.stream_features(streams.stream_json_files(spark, f"{root}/in", max_files=4), LATIN)
    streams.write_predictions(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    cols = (F.round(F.col(c).cast("double"), 6).alias(c) if c in q.RATIOS else F.col(c) for c in q.ALL_MEASURES)
    return spark.read.parquet(f"{root}/out").select("text", "true_label", "cleaned_text", "processed_text", *cols)


@query(
    "stream_file_score",
    f"""WITH {_MESSAGES} SELECT substr(text, 1, 100) AS text_preview, true_label, count(*) AS n, TRUE AS same FROM styled GROUP BY 1, 2""",
)
def stream_file_score(spark, sf_dir):
    """Per message text: how often it came out, and whether all its scores are those of the batch."""
    root, model, messages = scratch_dir(spark, "stream-score"), _pipeline(spark, sf_dir), t.messages(spark, sf_dir)
    _drop(messages, f"{root}/in")
    _run(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", model)
    keys = ("text_preview", "true_label")
    scores = F.sort_array(F.collect_list(F.struct("predicted_label", "p_human", "short_words_ratio", "total_physical_lines")))
    batch = reshape.prediction_view(model.transform(scoring.stream_features(messages, LATIN)))
    wanted = batch.groupBy(*keys).agg(scores.alias("wanted"))
    got = spark.read.parquet(f"{root}/out").groupBy(*keys).agg(scores.alias("got"))
    joined = got.alias("g").join(wanted.alias("w"), F.col("g.text_preview").eqNullSafe(F.col("w.text_preview")) & F.col("g.true_label").eqNullSafe(F.col("w.true_label")), "left")
    same = F.col("got").eqNullSafe(F.col("wanted")).alias("same")
    return joined.select("g.text_preview", "g.true_label", F.size("got").cast("long").alias("n"), same)


@query("stream_equals_batch", "SELECT count(*) AS n_rows, 0 AS n_different FROM conversations")
def stream_equals_batch(spark, sf_dir):
    """Scores of the stream against scores of the same messages in one batch."""
    root, model, messages = scratch_dir(spark, "stream-equal"), _pipeline(spark, sf_dir), t.messages(spark, sf_dir)
    _drop(messages, f"{root}/in")
    _run(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", model)
    cols = ("text_preview", "true_label", "predicted_label", "p_human", "short_words_ratio")
    stream = spark.read.parquet(f"{root}/out").select(*cols, F.lit(1).alias("side"))
    batch = reshape.prediction_view(model.transform(scoring.stream_features(messages, LATIN))).select(*cols, F.lit(-1).alias("side"))
    groups = stream.unionByName(batch).groupBy(*cols).agg(F.sum("side").alias("excess"), F.count_if(F.col("side") == 1).alias("n"))
    return groups.agg(F.sum("n").alias("n_rows"), F.sum(F.abs("excess")).alias("n_different"))


@query("stream_count", "SELECT count(*) AS n_records FROM conversations")
def stream_count(spark, sf_dir):
    root = scratch_dir(spark, "stream-count")
    _drop(t.messages(spark, sf_dir), f"{root}/in")
    _run(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", _pipeline(spark, sf_dir))
    return scoring.stream_count(spark, f"{root}/out")


@query("stream_two_sinks", f"WITH {_MESSAGES} {_VIEW.format(label='true_label')}")
def stream_two_sinks(spark, sf_dir):
    root = scratch_dir(spark, "stream-sinks")
    _drop(t.messages(spark, sf_dir), f"{root}/in")
    _run(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", _pipeline(spark, sf_dir), monitor=lambda batch, _: batch.count())
    return _known(spark.read.parquet(f"{root}/out"))


@query("stream_restart", f"WITH {_MESSAGES} {_VIEW.format(label='true_label')}")
def stream_restart(spark, sf_dir):
    root = scratch_dir(spark, "stream-restart")
    messages, model = t.messages(spark, sf_dir), _pipeline(spark, sf_dir)
    user = F.col("true_label").eqNullSafe(1)
    for part in (messages.filter(user), messages.filter(~user)):
        _drop(part, f"{root}/in", files=2)
        _run(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", model)
    return _known(spark.read.parquet(f"{root}/out"))


@query("stream_progress", "SELECT 4 AS n_batches, count(*) AS n_rows, TRUE AS timed FROM conversations")
def stream_progress(spark, sf_dir):
    root = scratch_dir(spark, "stream-progress")
    _drop(t.messages(spark, sf_dir), f"{root}/in")
    _run(spark, f"{root}/in", f"{root}/out", f"{root}/checkpoint", _pipeline(spark, sf_dir), progress=f"{root}/progress")
    summary = scoring.progress_summary(scoring.stream_progress(spark, f"{root}/progress"))
    timed = (F.col("first_batch_ms") > 0) & (F.col("rows_per_second") > 0)
    return summary.select("n_batches", "n_rows", timed.alias("timed"))


@query(
    "stream_metrics",
    """SELECT 4 AS n_batches, count(*) AS n_rows, count_if(text IS NULL) AS without_text, TRUE AS classes_equal, TRUE AS matrix_equal, count(*) AS n_records
        FROM conversations""",
)
def stream_metrics(spark, sf_dir):
    """Metrics observed in every batch against the same counts of one batch over all messages."""
    root, model, messages = scratch_dir(spark, "stream-metrics"), _pipeline(spark, sf_dir), t.messages(spark, sf_dir)
    _drop(messages, f"{root}/in")
    scored = scoring.stream_score(streams.stream_json_files(spark, f"{root}/in", max_files=1), model, LATIN)
    scoring.run_stream(
        scored, f"{root}/out", f"{root}/checkpoint", every=None, manifest=f"{root}/manifest", metrics=scoring.prediction_metrics()
    )
    batch = reshape.prediction_view(model.transform(scoring.stream_features(messages, LATIN)))
    wanted = batch.agg(*(c.alias(n) for n, c in scoring.prediction_metrics().items())).first().asDict()
    sums = scoring.listed_metrics(spark, f"{root}/manifest").groupBy("metric").agg(F.sum("n").alias("n"))
    found = sums.groupBy().agg(F.map_from_entries(F.collect_list(F.struct("metric", "n"))).alias("n"))  # a dozen metrics
    same = lambda names: F.forall(F.array(*(F.col("n")[c] == wanted[c] for c in names)), lambda x: x)
    last = scoring.running_confusion(spark, f"{root}/manifest").groupBy("label", "predicted").agg(F.max_by("n", "batch_id").alias("n"))
    matrix = {f"label_{r['label']}_predicted_{r['predicted']}": r["n"] for r in last.collect()}
    return found.select(
        F.lit(streams.listed_batches(spark, f"{root}/manifest").count()).alias("n_batches"),
        F.col("n")["rows"].alias("n_rows"),
        F.col("n")["without_text"].alias("without_text"),
        same(["predicted_0", "predicted_1"]).alias("classes_equal"),
        F.lit(matrix == {c: n for c, n in wanted.items() if c.startswith("label_")}).alias("matrix_equal"),
        F.lit(streams.read_listed(spark, f"{root}/manifest", batch.schema).count()).alias("n_records"),
    )


@query(
    "stream_confusion",
    """SELECT CASE role WHEN 'user' THEN 1 ELSE 0 END AS label, count(*) AS n, TRUE AS same FROM conversations
        WHERE role IN ('user', 'assistant') GROUP BY 1""",
)
def stream_confusion(spark, sf_dir):
    """The running matrix of a stream that was stopped and started again, against the matrix of one batch."""
    root, model, messages = scratch_dir(spark, "stream-confusion"), _pipeline(spark, sf_dir), t.messages(spark, sf_dir)
    late = F.pmod(F.xxhash64("text"), F.lit(2)) == 1
    for part in (messages.filter(~F.coalesce(late, F.lit(False))), messages.filter(late)):
        _drop(part, f"{root}/in", files=2)
        scored = scoring.stream_score(streams.stream_json_files(spark, f"{root}/in", max_files=1), model, LATIN)
        scoring.run_confusion(scored, f"{root}/out", f"{root}/manifest", f"{root}/checkpoint").awaitTermination()
    batch = reshape.prediction_view(model.transform(scoring.stream_features(messages, LATIN)))
    wanted = evaluation.confusion_matrix(batch.withColumnRenamed("predicted_label", "prediction"), "true_label")
    joined = scoring.latest_confusion(spark, f"{root}/manifest").join(wanted.withColumnRenamed("n", "wanted"), ["label", "prediction"])
    return joined.groupBy("label").agg(F.sum("n").alias("n"), F.min(F.col("n") == F.col("wanted")).alias("same"))

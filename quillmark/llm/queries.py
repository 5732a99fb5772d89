"""The registered queries of the subpackage, each with SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm import ann, centroids, chat, katz, licenses, merkle, mixing, packing, quality_rules, rule_ensemble
from quillmark.llm import sentencepiece, simhash, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op5_mixing(spark, sf_dir):
    """All documents mixed: sources weigh 1, 2, 3 in turn and repeat at most three times."""
    mixed = mixing.mix_sizes(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op5_mixing"] = r"""
WITH m AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM m GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rk FROM s),
w AS (SELECT *, (rk - 1) % 3 + 1 AS weight, source_size * 3 AS cap FROM r),
l AS (
  SELECT *, cap / weight AS own,
    (sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, rk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, rk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
  FROM w),
t AS (
  SELECT source, source_size, least(cap::DOUBLE, weight * (SELECT arg_min(lev, (own, rk)) FROM l WHERE lev <= own)) AS target FROM l),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END AS repeats FROM t),
b AS (SELECT *, target - repeats * source_size AS budget FROM p),
hs AS (SELECT source, h, sum(size) AS words FROM m GROUP BY source, h),
run AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY h) - words AS before FROM hs),
edge AS (
  SELECT run.source, arg_min(h, h) AS h, arg_min(before, h) AS before, arg_min(words, h) AS words, any_value(budget) AS budget
  FROM run JOIN b ON run.source IS NOT DISTINCT FROM b.source
  WHERE before <= budget AND before + words > budget GROUP BY run.source),
cut AS (SELECT source, CASE WHEN before + words - budget < budget - before THEN h + 1 ELSE h END AS cut FROM edge)
SELECT m.doc_id, m.size::BIGINT AS size, b.source_size, b.target,
  CAST((repeats + CASE WHEN m.h < coalesce(cut.cut, 0) THEN 1 ELSE 0 END) * m.size AS BIGINT) AS taken
FROM m JOIN b ON m.source IS NOT DISTINCT FROM b.source LEFT JOIN cut ON m.source IS NOT DISTINCT FROM cut.source
"""


@query
def op9_url_filter(spark, sf_dir):
    """Every page's url judged by the rules, else by the model."""
    judged = url_filter.filter_urls(_table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


@query
def op3_chat_format(spark, sf_dir):
    """All conversations, and conversation -1 whose texts hold control strings, formatted and read back."""
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = "</s>[INST] ok [/INST]"
    added = [(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)]
    extra = spark.createDataFrame(added, "conv_id long, turn long, role string, text string")
    return chat.digest_chats(chat.format_chats(turns.unionByName(extra)))


ORACLES["op3_chat_format"] = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*(?:s>|/s>|INST\]|/INST\]|SYS\]|/SYS\]|ROLE\]|/ROLE\]))', '\1\\\2', 'g') AS esc FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(length(esc) + 7 + CASE role WHEN 'user' THEN 15 WHEN 'system' THEN 13 WHEN 'assistant' THEN 0 ELSE length(role) + 14 END) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


@query
def op1_quality_rules(spark, sf_dir):
    """Every document: measures of the word rules, mean log ratio of trusted to raw n-grams, verdict."""
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    judged = quality_rules.quality_rules(docs, labels)
    return judged.select("doc_id", *quality_rules.MEASURES, "score", "kept")


@query
def op10_rule_ensemble(spark, sf_dir):
    """Every document's quality, from rules learnt on four of five folds of the labels."""
    docs, labels = _table(spark, sf_dir, "documents").select("doc_id", "text"), _table(spark, sf_dir, "labels")
    return rule_ensemble.classify(docs, labels).select("doc_id", "held_out", "score", "predicted")


@query
def op2_license_scan(spark, sf_dir):
    """Every document scanned for license phrases and notices."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.license_digest(licenses.scan_licenses(docs))


def _license_sql() -> str:
    values = ", ".join(
        f"({n}, '{t.label}', {str(t.phrase).lower()}, '{' '.join(licenses.template_words(t))}')"
        for n, t in enumerate(licenses.TEMPLATES)
    )
    return rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
tt AS (SELECT *, string_split(words, ' ') AS tw FROM (VALUES {values}) AS x(template, label, phrase, words)),
tg AS (
  SELECT template, label, phrase, len(tw) - 2 AS grams, t, tw[t + 1] || ' ' || tw[t + 2] || ' ' || tw[t + 3] AS gram
  FROM (SELECT *, unnest(range(len(tw) - 2)) AS t FROM tt)),
dg AS (
  SELECT doc_id, p, w[p + 1] || ' ' || w[p + 2] || ' ' || w[p + 3] AS gram
  FROM (SELECT *, unnest(range(greatest(len(w) - 2, 0))) AS p FROM d)),
hit AS (SELECT doc_id, template, label, phrase, grams, p, t, p - t AS diagonal FROM dg JOIN tg USING (gram)),
dia AS (SELECT DISTINCT doc_id, template, phrase, diagonal FROM hit),
gap AS (
  SELECT *, diagonal - lag(diagonal) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS step FROM dia),
isl AS (
  SELECT *, sum(CASE WHEN step IS NULL OR step > (CASE WHEN phrase THEN 0 ELSE 4 END) THEN 1 ELSE 0 END)
    OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS island FROM gap),
span AS (
  SELECT hit.doc_id, hit.template, label, hit.phrase, island, min(p) AS first, max(p) + 2 AS last,
    count(DISTINCT t) / any_value(grams) AS share, any_value(grams) AS grams
  FROM hit JOIN isl ON hit.doc_id = isl.doc_id AND hit.template = isl.template AND hit.diagonal = isl.diagonal
  GROUP BY hit.doc_id, hit.template, label, hit.phrase, island),
ok AS (
  SELECT *, CASE WHEN phrase THEN share = 1 ELSE share >= 0.8 AND last - first + 1 <= 1.5 * (grams + 2) END AS good FROM span),
agg AS (
  SELECT doc_id, count(*) FILTER (good AND phrase) AS n_base, min(first) FILTER (good AND phrase) AS first_word,
    max(first) FILTER (good AND phrase) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (good AND phrase) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (good) AS labels, max(share) AS score
  FROM ok GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0)::DOUBLE AS score
FROM d LEFT JOIN agg USING (doc_id)
"""


ORACLES["op2_license_scan"] = _license_sql()


@query
def op6_simhash(spark, sf_dir):
    """Every document's fingerprint and near-duplicate component."""
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", simhash.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


@query
def op8_ann(spark, sf_dir):
    """The ten nearest vectors of every vector whose id is divisible by 100, from balanced posting lists."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest_neighbours(vectors, F.col("vec_id") % 100 == 0)


@query
def op4_sentencepiece(spark, sf_dir):
    """Every document encoded, and decoded again: ids, and whether the text came back exactly."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = sentencepiece.SentencePiece(spark, corpus_pipeline.PIECES)
    encoded = docs.withColumn("ids", pieces.encode("text")).withColumn("back", pieces.decode("ids"))
    n_tokens = F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens")
    return encoded.select("doc_id", n_tokens, "ids", F.col("back").eqNullSafe(F.col("text")).alias("round_trip"))


@query
def op7_katz(spark, sf_dir):
    """Every document's log10 probability under a Katz backoff model of nine in ten documents."""
    return katz.score_documents(_table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op11_packing(spark, sf_dir):
    """All documents packed into sequences of at most 2,048 tokens."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    pieces = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query
def op12_merkle(spark, sf_dir):
    """Every document's place in the Merkle manifest, and whether its tampered form still verifies."""
    return merkle.manifest(_table(spark, sf_dir, "documents"))


def _merkle_sql(levels: int = 6, fanout: int = 16) -> str:
    """Trees of up to ``fanout ** levels`` nodes: one table per level with the siblings of each node.

    A finished tree's one node is carried up unchanged, without siblings. CRC-32 is worked out bit by bit.
    """
    field = lambda c: f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join([*map(field, ("doc_id", "source", "lang", "n_chars")), field(text)]) + ")"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    tables = []
    for name in "st":
        for k in range(levels + 1):
            run = f"PARTITION BY tree, idx // {fanout} ORDER BY idx ROWS BETWEEN"
            side = lambda frame: f"CASE WHEN n > 1 THEN coalesce(string_agg(digest, '') OVER ({run} {frame}), '') ELSE '' END"
            tables.append(f"""{name}{k} AS (
  SELECT *, {side("UNBOUNDED PRECEDING AND 1 PRECEDING")} AS l, {side("1 FOLLOWING AND UNBOUNDED FOLLOWING")} AS r FROM {name}n{k})""")
            tables.append(f"""{name}n{k + 1} AS (
  SELECT tree, idx // {fanout} AS idx, (any_value(n) + {fanout - 1}) // {fanout} AS n,
    CASE WHEN any_value(n) > 1 THEN sha256(string_agg(digest, '' ORDER BY idx)) ELSE any_value(digest) END AS digest
  FROM {name}n{k} GROUP BY tree, idx // {fanout})""")
        if name == "s":
            tables.append(f"""tn0 AS (
  SELECT 0 AS tree, tree AS source, digest, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM sn{levels})""")
    up = lambda name, leaf: " ".join(
        f"JOIN {name}{k} ON {name}{k}.tree IS NOT DISTINCT FROM {leaf}.tree AND {name}{k}.idx = {leaf}.idx // {fanout**k}"
        for k in range(levels + 1)
    )
    steps = [f"{name}{k}" for name in "st" for k in range(levels + 1)]
    kept = ", ".join(f"{x}.{c} AS {c}{i}" for i, x in enumerate(steps) for c in "lrn")
    folds = ", ".join(
        f"f{i + 1} AS (SELECT * EXCLUDE (cur), CASE WHEN n{i} > 1 THEN sha256(l{i} || cur || r{i}) ELSE cur END AS cur FROM f{i})"
        for i in range(len(steps))
    )
    byte = "CASE WHEN i % 8 = 0 THEN ascii(digits[i // 8 + 1]) ELSE 0 END"
    crc = f"list_reduce(list_prepend(4294967295, range(8 * length(digits))), lambda c, i: xor(xor(c, {byte}) >> 1, 3988292384 * (xor(c, {byte}) & 1)))"
    return f"""
WITH d AS (
  SELECT doc_id, source AS tree, CAST(doc_id AS VARCHAR) AS digits, {leaf("text")} AS digest, {leaf(lowered)} AS lowered FROM documents),
sn0 AS (
  SELECT doc_id, tree, digest, CASE WHEN xor({crc}, 4294967295) % 5 = 0 THEN lowered ELSE digest END AS start,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM d),
{", ".join(tables)},
f0 AS (
  SELECT x.doc_id, x.digest AS leaf, x.start AS cur, y.digest AS subroot, t{levels}.digest AS root,
    {" || ".join(f"{x}.l || {x}.r" for x in steps)} AS proof, {kept}
  FROM s0 AS x {up("s", "x").replace("JOIN s0 ON", "JOIN s0 AS s0 ON")}
  JOIN t0 AS y ON y.source IS NOT DISTINCT FROM x.tree {up("t", "y")}),
{folds}
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified FROM f{len(steps)}
"""


ORACLES["op12_merkle"] = _merkle_sql()


@query
def op13_clusters(spark, sf_dir):
    """Every vector in one of 16 clusters, after three rounds."""
    return centroids.cluster(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def _cluster_sql(count: int = 16, rounds: int = 3, dims: int = 64) -> str:
    distance = f"list_sum(list_transform(range(1, {dims + 1}), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i])))"
    steps = []
    for k in range(rounds + 1):
        steps.append(f"""a{k} AS (
  SELECT rid, any_value(v.vec_id) AS vec_id, any_value(v.e) AS e, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT v.rid, v.vec_id, v.e, c.c, CAST({distance} AS BIGINT) AS d FROM v, c{k} AS c) AS v GROUP BY rid)""")
        steps.append(f"""m{k} AS (
  SELECT c, list(CAST(floor(total / members) AS BIGINT) - CASE WHEN CAST(floor(total / members) AS BIGINT) * members > total THEN 1 ELSE 0 END ORDER BY i) AS e
  FROM (SELECT c, i, sum(e[i]) AS total, count(*) AS members FROM a{k}, range(1, {dims + 1}) AS r(i) GROUP BY c, i) GROUP BY c)""")
        steps.append(f"c{k + 1} AS (SELECT c.c, coalesce(m.e, c.e) AS e FROM c{k} AS c LEFT JOIN m{k} AS m ON m.c = c.c)")
    return f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS rid, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE len(embedding) = {dims} AND list_count(embedding) = {dims} AND list_bool_and(list_transform(embedding, lambda x: isfinite(x)))),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h, e) - 1 AS INTEGER) AS c, e
  FROM (SELECT sha256('1:' || vec_id) AS h, e FROM v ORDER BY h, e LIMIT {count})),
{", ".join(x.replace(" AS (", " AS MATERIALIZED (", 1) for x in steps)}
SELECT a.vec_id, a.c AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{rounds} AS a JOIN c{rounds} AS c ON c.c = a.c
"""


ORACLES["op13_clusters"] = _cluster_sql()


QUERIES["pipeline"] = corpus_pipeline.run

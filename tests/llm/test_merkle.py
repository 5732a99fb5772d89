"""Merkle manifest against a plain one: heights, runs of one, ties, nulls."""

import hashlib
import zlib

import llm_cases as cases
from pyspark.sql import functions as F

from quillmark.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(digests):
    """Root and, for each leaf, the siblings (left, right) of every level."""
    paths, groups, level = [[] for _ in digests], [[i] for i in range(len(digests))], list(digests)
    while len(level) > 1:
        up, merged = [], []
        for at in range(0, len(level), 16):
            run = level[at : at + 16]
            for k in range(len(run)):
                for leaf in groups[at + k]:
                    paths[leaf].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(sha("".join(run)))
            merged.append([x for g in groups[at : at + 16] for x in g])
        level, groups = up, merged
    return level[0], paths


def plain_manifest(rows):
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: sha("".join(map(enc, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text))))
    sources, out = {}, []
    for r in rows:
        low = r["text"] and "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"])
        touched = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        mine = leaf(r, r["text"])
        sources.setdefault(r["source"], []).append((r["doc_id"], mine, leaf(r, low) if touched else mine))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        sources[s].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = [plain_tree([x[1] for x in sources[s]]) for s in names]
    root, above = plain_tree([t[0] for t in trees])
    for s, (subroot, paths), over in zip(names, trees, above):
        for (doc_id, mine, start), path in zip(sources[s], paths):
            path, folded = path + over, start
            for left, right in path:
                folded = sha(left + folded + right)
            proof = sha("".join(left + right for left, right in path))
            out.append((doc_id, mine, subroot, root, proof, folded, folded == root))
    return out


def rows_of(df):
    return [tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")) for r in df.collect()]


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1:]))


def table(spark, sizes, repeat=1):
    rows = [(i, f"Text {i}", "en", s, i) for s, ids in sizes for i in ids for _ in range(repeat)]
    return spark.createDataFrame(rows, cases.SCHEMA).repartition(5)


def test_equals_plain_tree_at_many_heights(spark):
    sizes, at = [], 0
    for n, s in zip((1, 2, 15, 16, 17, 33, 256, 257, 1100), (None, "", "a", "b", "é", "Z", "z", "\U0001f600", "￿")):
        sizes.append((s, range(at, at + n)))
        at += n
    docs = table(spark, sizes)
    assert order(rows_of(merkle.manifest(docs))) == order(plain_manifest(docs.collect()))


def test_more_sources_than_a_run(spark):
    docs = table(spark, [(f"s{i:03d}", range(10 * i, 10 * i + 1 + i % 3)) for i in range(300)])
    assert order(rows_of(merkle.manifest(docs))) == order(plain_manifest(docs.collect()))


def test_odd_rows_and_repeats(spark):
    docs = cases.documents(spark).withColumns({c: F.lit(1) for c in ("leaf", "root", "digest", "idx", "path", "n", "top", "copies", "_range")})
    found = rows_of(merkle.manifest(docs))
    assert order(found) == order(plain_manifest(docs.collect())) and len(found) == len(cases.ROWS)
    repeated = table(spark, [("a", range(40))], repeat=30)
    assert order(rows_of(merkle.manifest(repeated))) == order(plain_manifest(repeated.collect()))


def test_single_row_and_empty_table(spark):
    one = table(spark, [("a", [5])])
    row = merkle.manifest(one).first()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == sha("")
    assert merkle.manifest(cases.empty(spark)).count() == 0


def test_tampering_shows_only_where_text_changes(spark):
    docs = spark.createDataFrame([(i, "UPPER" if i % 2 else "lower", "en", "a", 5) for i in range(200)], cases.SCHEMA)
    for r in merkle.manifest(docs).collect():
        touched = zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        assert r["verified"] == (not touched or r["doc_id"] % 2 == 0)


def test_windows_never_span_a_whole_source(spark):
    plan = merkle.with_siblings(spark.range(10).selectExpr("'a' AS t", "id AS idx", "10L AS n", "'d' AS digest"), "t")
    text = plan._jdf.queryExecution().analyzed().toString()
    assert "_block" in text and "windowspecdefinition(t" in text and "_block#" in text.split("windowspecdefinition(t", 1)[1][:40]

"""SimHash groups against brute force, and the claims about the code."""

import llm_cases as cases
import numpy as np
import xxhash
from pyspark.sql import functions as F

from quillmark.llm import components, simhash as q
from quillmark.llm.text import stored


def _fingerprint(text):
    words = cases.words(cases.lowered(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for i in range(64):
            counts[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * counts[i] > len(shingles))


def _groups(prints):
    """Smallest index reachable by steps of at most two bits."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


def test_words_two_bits_apart_share_a_codeword_and_none_has_more_than_six():
    rng, tables = np.random.default_rng(1), q.golay_tables()
    words = rng.integers(0, 1 << 23, 3000)
    mine = [set(x) for x in q.codeword_indices(words, tables).tolist()]
    assert {len(x) for x in mine} <= {1, 6}
    for a, b in [(0, 0), (3, 3), (5, 17), (0, 22), (9, 11)]:
        other = q.codeword_indices(words ^ (1 << a) ^ (1 << b if a != b else 0), tables)
        assert all(x & set(y) for x, y in zip(mine, other.tolist()))


def test_fingerprints_and_components_equal_brute_force(spark):
    got = q.near_duplicates(cases.documents(spark)).collect()
    wanted = {}
    for doc_id, text, *_ in cases.ROWS:
        wanted.setdefault(doc_id, []).append(_fingerprint(text))
    assert len(got) == len(cases.ROWS)
    assert all(r["fp"] % (1 << 64) in wanted[r["doc_id"]] for r in got)
    prints = [_fingerprint(r[1]) for r in cases.ROWS]
    roots = _groups(prints)
    least = {}
    for root, row in zip(roots, cases.ROWS):
        least[root] = min([x for x in (least.get(root), row[0]) if x is not None], default=None)
    expected = sorted((str(row[0]), f"{p:016x}", str(least[root])) for row, p, root in zip(cases.ROWS, prints, roots))
    shown = q.near_duplicates(cases.documents(spark)).select("doc_id", q.hex_digits(F.col("fp")), "component_id").collect()
    assert sorted((str(a), b, str(c)) for a, b, c in shown) == expected


def test_pairs_and_crowded_keys_connect_the_same(spark):
    rng = np.random.default_rng(3)
    prints = set()
    for center in rng.integers(0, 1 << 63, 12).tolist():
        prints.add(center)
        for _ in range(40):
            bits = rng.integers(0, 64, rng.integers(1, 5))
            prints.add(center ^ sum({1 << int(b) for b in bits}))
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    table = spark.createDataFrame([(s,) for s in signed], "fp long")
    roots = _groups(prints)
    members = {}
    for p, r in zip(signed, roots):
        members.setdefault(r, set()).add(p)
    wanted = {frozenset(m) for m in members.values() if len(m) > 1}
    for bucket in (1, 6, 10_000):
        found = components.components(q.links(table, bucket=bucket)).groupBy("root").agg(F.collect_set("node").alias("n"))
        assert {frozenset(r["n"]) for r in found.collect()} == wanted


def test_components_of_long_paths_hubs_and_loops(spark):
    path = [(i, i + 1) for i in range(200)]
    hub = [(1000, i) for i in range(1001, 1400)]
    links = spark.createDataFrame([*path, *hub, (7, 7), (5000, 4000), (4000, 5000), (None, 3)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(links).collect()}
    assert got == {**{i: 0 for i in range(201)}, **{i: 1000 for i in range(1000, 1400)}, 4000: 4000, 5000: 4000}
    assert components.components(links.limit(0)).collect() == []


def test_one_row_of_each_group_stays(spark):
    docs = cases.documents(spark)
    kept = q.near_dedup(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    groups = len(set(_groups([_fingerprint(r[1]) for r in cases.ROWS])))
    assert len(rows) == groups
    ids = [r["doc_id"] for r in rows]
    assert 1 in ids and 2 not in ids and 3 in ids and 4 not in ids and ids.count(None) == 1
    assert q.near_dedup(cases.empty(spark)).collect() == []


def test_wide_links_equal_brute_force_jaccard(spark):
    rng = np.random.default_rng(5)
    texts = []
    for family in range(12):
        base = [f"w{x}" for x in rng.integers(0, 5000, 120)]
        for _ in range(8):
            words = list(base)
            for at in rng.integers(0, len(words), rng.integers(0, 5)):
                words[at] = f"v{rng.integers(0, 5000)}"
            texts.append(" ".join(words))
    shingles = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    prints = [_fingerprint(t) for t in texts]
    links, beyond = [], 0
    for i in range(len(texts)):
        for j in range(i):
            alike = 5 * len(shingles[i] & shingles[j]) >= 4 * len(shingles[i] | shingles[j])
            close = (prints[i] ^ prints[j]).bit_count() <= 2
            beyond += alike and not close
            if alike or close:
                links.append((i, j))
    assert beyond > 20
    least = list(range(len(texts)))
    for _ in texts:
        for i, j in links:
            least[i] = least[j] = min(least[i], least[j])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    wanted = sorted(set(least))
    assert sorted(r[0] for r in q.near_dedup(docs, wide=True).select("doc_id").collect()) == wanted
    prints = docs.select("doc_id", q.simhash("text").alias("fp"), F.xxhash64("text").alias("tid"), q.wide_keys("text").alias("wide"))
    for bucket in (1, 3):
        more = q.similar_links(prints, docs, bucket=bucket)
        assert sorted({r[0] for r in q._grouped(prints, more).select("component_id").collect()}) == wanted


def test_a_crowd_of_near_copies_costs_in_proportion_and_loses_no_link(spark):
    """Copies with none to many words changed: most do not link to the least one of their keys."""
    rng = np.random.default_rng(9)

    def crowd(n):
        base, texts = [f"w{x}" for x in rng.integers(0, 5000, 150)], []
        for _ in range(n):
            words = list(base)
            for at in rng.integers(0, len(words), rng.integers(0, 12)):
                words[at] = f"v{rng.integers(0, 100_000)}"
            texts.append(" ".join(words))
        return sorted(set(texts))

    made = {}
    for n in (400, 800):
        texts = crowd(n)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
        prints = docs.select("doc_id", q.simhash("text").alias("fp"), F.xxhash64("text").alias("tid"), q.wide_keys("text").alias("wide"))
        prints = stored(prints, "t")
        calls = []
        real = q.stored
        q.stored = lambda df, name: calls.append((name, real(df, name))) or calls[-1][1]
        try:
            links = q.similar_links(prints, docs)
        finally:
            q.stored = real
        groups = {r["doc_id"]: r["component_id"] for r in q._grouped(prints, links).collect()}
        if n == 400:
            sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
            fps = [_fingerprint(t) for t in texts]
            pairs = [
                (i, j)
                for i in range(len(texts))
                for j in range(i)
                if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) or (fps[i] ^ fps[j]).bit_count() <= 2
            ]
            joined = sum(groups[i] == groups[j] for i, j in pairs)
            assert joined >= 0.99 * len(pairs) > 1000
        made[n] = sum(df.count() for name, df in calls if name in ("similar-candidates", "band-shared"))
    assert made[800] < 3 * made[400]

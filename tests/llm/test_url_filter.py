"""URL filter: parts, rules and the model."""

import re

from pyspark.sql import functions as F

from quillmark.llm import url_filter as q

URLS = [
    "http://Example.NET/en/1", "https://a.b.example.net/en/", "http://example.net/EN/1", "http://notexample.net/x",
    "https://example.net", "http://x.example.com/de/1?q=/fr/", "http://example.com/fr/1", "http://w.org/fr/a#x", "http://w.org/fr",
    "http://user@host.net:80/a", "ftp://net/", "://net/x", "a://b://c/d", None, "", "no scheme", "http://", "http:///p", "HTTP://\u00c9.NET/a",
    "http://free-bets.example.com/en/1", "http://city-library.example.com/en/1", "http://x.org/" + "p" * 100_000, "http://a.net/\nline",
]


def _parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def _rule(host, path):
    fits = [
        (len(h + p), h + p, v) for v, h, p in q.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    return max(fits)[1:] if fits else (None, None)


def test_parts_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "mine", "mine") for i, u in enumerate(URLS)], "page_id long, url string, host string, score string")
    got = {r["page_id"]: r for r in q.filter_urls(pages).collect()}
    assert len(got) == len(URLS)
    for i, url in enumerate(URLS):
        row, parts = got[i], _parts(url)
        assert (row["host"], row["path"]) == parts, url
        rule, verdict = _rule(*parts)
        assert row["rule"] == rule
        assert row["verdict"] == verdict if rule else (row["verdict"] == "block") == (row["score"] >= 0.5)
        assert 0 <= row["score"] <= 1
    assert got[URLS.index("http://free-bets.example.com/en/1")]["verdict"] == "block"
    assert got[URLS.index("http://city-library.example.com/en/1")]["verdict"] == "allow"
    assert q.filter_urls(pages.limit(0)).collect() == []


def test_held_out_accuracy(spark):
    rows = q.labelled_urls(spark).withColumn("word", F.regexp_extract("url", r"([a-z-]+)\.example", 1))
    held = F.pmod(F.crc32(F.col("word").cast("binary")), F.lit(4)) == 0
    model = q.train_url_model(rows.filter(~held).drop("word"))
    judged = q.filter_urls(rows.filter(held), model, rules=())
    right = judged.filter((F.col("verdict") == "block") == (F.col("label") == 1)).count()
    assert right / judged.count() > 0.6
    seen = q.filter_urls(rows, q.train_url_model(rows.drop("word")), rules=())
    assert seen.filter((F.col("verdict") == "block") == (F.col("label") == 1)).count() == seen.count()


def test_unseen_words_are_judged_right_and_scores_equal_plain_python(spark):
    import math

    from pyspark.ml.feature import HashingTF

    unseen = "casino-win free-bets ads-track cheap-pills spam-farm poker-spin bets-tips".split()
    assert not set(unseen) & set(q.UNWANTED)
    plain = "thern-tionon anden-verein library-card mountain-trail science-weekly family-recipes stadt-theater".split()
    assert not set(plain) & set(q.ORDINARY)
    rows = [(f"https://{w}.example.org/es/{i}", w in unseen) for i, w in enumerate([*unseen, *plain])]
    model = q.train_url_model(q.labelled_urls(spark))
    judged = q.filter_urls(spark.createDataFrame(rows, "url string, unwanted boolean"), model).collect()
    right = sum((r["verdict"] == "block") == r["unwanted"] for r in judged if r["rule"] is None)
    assert right >= 0.85 * len(judged)
    hashing, weights, intercept = HashingTF(numFeatures=1 << 16), model.coefficients.toArray(), model.intercept
    for r in judged[::3]:
        grams = set()
        for mark, text in (("h:", r["host"]), ("p:", r["path"])):
            text = f"^{text}$"
            grams |= {mark + text[i : i + n] for n in (3, 4, 5) for i in range(len(text) - n + 1)}
        margin = intercept + sum(weights[i] for i in {hashing.indexOf(g) for g in grams})
        assert abs(r["score"] - 1 / (1 + math.exp(-margin))) < 1e-9


def test_columns_of_the_caller_stay(spark):
    df = spark.createDataFrame([("https://a.example.org/es/1", "mine", "mine", "mine")], "url string, _url_note string, _url_features string, decided string")
    row = q.filter_urls(df).first()
    assert (row["_url_note"], row["_url_features"], row["decided"]) == ("mine",) * 3

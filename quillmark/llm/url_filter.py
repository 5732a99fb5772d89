"""URL filter: host and path rules first, else logistic regression on hashed character n-grams."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.llm.text import packed, unpacked

#: (verdict, host, path): a rule fits its host, all subdomains and all paths that start with its path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)

#: The small labelled table: words that hosts or paths of unwanted and of ordinary pages are made of.
UNWANTED = (
    "xxx-video hot-girls sex-cam porn-hub nude-pics live-escort adult-chat adult-movies casino-royal online-casino "
    "slot-jackpot poker-bonus free-spins sports-betting betting-tips lucky-spin diet-pills buy-viagra pharma-deal "
    "weight-loss cheap-meds pills-online ad-click popup-ads track-pixel banner-ads ads-server tracking-click "
    "link-farm seo-spam spam-blog spammer-mail free-money fast-cash payday-loan crypto-giveaway win-prize "
    "winning-lotto bets-online free-download warez-crack serial-keygen torrent-movies replica-watch cheap-bags cheap-rolex"
).split()
ORDINARY = (
    "daily-news city-library open-science python-docs linux-kernel wiki-pages history-museum school-board "
    "university-press garden-club weather-report train-times recipe-book travel-notes music-review film-review "
    "book-shop health-service law-journal math-forum code-review photo-album local-council art-gallery "
    "bird-watch chess-club astronomy-today climate-data open-maps language-school nature-trails old-letters "
    "north-sea harbour-town river-valley mountain-hut green-energy public-radio family-tree word-origins "
    "the-theatre southern-times internet-archive information-desk education-station gesellschaft handwerk-verein "
    "allemagne-tourisme bibliotheque maison-culture universidad-nacional entre-lineas montagne-sentier lectura-abierta "
    "growth-method earth-month northern-youth truth-society other-thoughts smith-brothers fifth-street the-fourth-estate "
    "kindergarten forschung-heute zeitung-archiv rathaus-stadt theater-probe commune-mairie histoire-moderne recherche-sante "
    "revista-ciencia biblioteca-ciudad estudios-sociales viajes-montes weekly-letter community-choir science-teaching"
).split()
HOSTS = ("{0}.example.com", "www.{0}.example.org", "blog.{0}.example.net", "m.{0}.example.com")
PATHS = ("/en/12", "/fr/345.html", "/de/6789/", "/es/41", "", "/")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*+)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*+([^?#]*+)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """Text and verdict of the longest fitting rule (a rule's length is that of host and path), else nulls."""
    rule = verdict = F.lit(None).cast("string")
    for action, name, start in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        rule = F.when(fits, F.lit(name + start)).otherwise(rule)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def _marked(mark: str, n: int):
    return lambda gram: F.concat(F.lit(mark), *(gram[f"c{i}"] for i in range(n)))


def _grams(text: Column, mark: str, sizes: tuple[int, ...]) -> Column:
    """Character n-grams of ``^text$``, marked. Shifted copies of the characters are zipped: linear in the length."""
    chars = F.split(F.concat(F.lit("^"), text, F.lit("$")), "")
    found = []
    for n in sizes:
        rest = [F.slice(chars, i + 1, F.greatest(F.size(chars) - i, F.lit(0))).alias(f"c{i}") for i in range(n)]
        whole = F.slice(F.arrays_zip(*rest), 1, F.greatest(F.size(chars) - (n - 1), F.lit(0)))
        found.append(F.transform(whole, _marked(mark, n)))
    return F.concat(*found)


def with_features(df: DataFrame, host: str, path: str, buckets: int = 1 << 16, sizes=(3, 4, 5)) -> DataFrame:
    """Add ``_url_features``: counts of hashed n-grams of host and path."""
    grams = F.concat(_grams(F.col(host), "h:", sizes), _grams(F.col(path), "p:", sizes))
    made = df.withColumn("_url_grams", grams)
    return HashingTF(numFeatures=buckets, inputCol="_url_grams", outputCol="_url_features", binary=True).transform(made)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """The small labelled table ``(url, label)``: 1 is unwanted. Paths say nothing, as in both classes."""
    rows = [
        (f"https://{HOSTS[(i + j) % len(HOSTS)].format(word)}{PATHS[(i + 2 * j) % len(PATHS)]}", float(label))
        for label, words in ((1, UNWANTED), (0, ORDINARY))
        for i, word in enumerate(words)
        for j in range(2)
    ]
    return spark.createDataFrame(rows, "url string, label double").coalesce(1)


def train_url_model(labelled: DataFrame, reg: float = 0.005):
    """Logistic regression on the n-grams of a table ``(url, label)``."""
    parts = labelled.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "label")
    features = with_features(parts, "host", "path")
    return LogisticRegression(featuresCol="_url_features", labelCol="label", regParam=reg, maxIter=60).fit(features)


def filter_urls(pages: DataFrame, model=None, rules=RULES, url: str = "url", threshold: float = 0.5) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``score`` and ``verdict`` (``block`` or ``allow``).

    A fitting rule decides; without one the model does: ``block`` from ``threshold`` on. A null url, or
    one without ``://``, has empty host and path; no rule fits, and the model judges the empty strings.
    Columns named like a result are replaced; repeated rows get equal results; no row is lost.
    """
    model = model or train_url_model(labelled_urls(pages.sparkSession))
    names = [n for n in ("host", "path", "rule", "score", "verdict") if n.lower() != url.lower()]
    rows = packed(pages, *names, url=url).withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rule, decided = matching_rule(F.col("host"), F.col("path"), rules)
    shown = with_features(rows, "host", "path").withColumns({"rule": rule, "decided": decided})
    named = model.setFeaturesCol("_url_features").setPredictionCol("_url_p").setProbabilityCol("_url_prob")
    score = vector_to_array("_url_prob")[1]
    scored = named.setRawPredictionCol("_url_raw").transform(shown).withColumn("score", score)
    by_model = F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return unpacked(scored, "host", "path", "rule", "score", F.coalesce("decided", by_model).alias("verdict"))

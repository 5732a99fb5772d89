"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A fingerprint has 64 bits, and two link where at most two differ. The perfect binary Golay code of
length 23 corrects three errors, so any two words of 23 bits at distance two or less lie within distance
four of a common codeword, and no word has more than six codewords that near. A fingerprint is cut into
three segments. Two errors leave one segment untouched: its bits, together with the indices of the
codewords near the next segment, are keys that linked fingerprints must share. Keys are joined and
candidates verified; a key that many share goes another, exact way (see :func:`links`).

Texts a few words apart are often more than two bits apart. A second kind of link, off by default, joins texts
whose sets of five-word shingles have a Jaccard similarity of 0.8 or more (see :func:`similar_links`).
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmark.llm.components import components
from quillmark.llm.text import packed, stored, unpacked

SHINGLE = 3
SEED = 42
GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1 generates the Golay code
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width
BUCKET = 48  # fingerprints under one key that are compared in pairs
WIDE = 5  # words in a shingle of the similarity links, which ask for a Jaccard similarity of 4/5
BANDS, BAND_ROWS = 25, 5  # a pair at 4/5 shares no band with a probability of (1 - 0.8**5)**25, 5 in 100,000
FURTHER_BANDS = 24  # keys of each later level, whose bands are twice as long as the last one's
WIDE_BUCKET = 16  # texts under one band's key that are compared in pairs
SKETCH_APART = 27  # of 125 sketch bits: a pair at 4/5 differs in 12.5 on average, deviation 3.4; beyond 27 once in 100,000


def shingle_hashes(text: bytes | None, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of the whole text if it has fewer; none for null and blank texts."""
    words = (text or b"").lower().split()  # bytes: folds A-Z and splits at ASCII white space only
    if not words:
        return np.zeros(0, "<u8")
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate(([0], ends[:-1]))
    last = max(len(words) - size, 0)
    spans = zip(starts[: last + 1].tolist(), (ends[min(size, len(words)) - 1 :] - 1).tolist())
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")


def fingerprint_of(text: bytes | None) -> int:
    """Unsigned fingerprint of one text in UTF-8; null and blank texts have 0."""
    hashes = shingle_hashes(text, SHINGLE)
    if not len(hashes):
        return 0
    counts = _byte_counts(hashes.view(np.uint8).reshape(-1, 8))
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def _byte_counts(rows: np.ndarray) -> np.ndarray:
    """How often each of 64 bits is set: a histogram of byte values per byte, times the bits of each value."""
    values = np.zeros((8, 256), np.int64)
    for block in range(0, len(rows), 1 << 16):
        part = rows[block : block + (1 << 16)].astype(np.uint16) + np.arange(0, 2048, 256, dtype=np.uint16)
        values += np.bincount(part.ravel(), minlength=2048).reshape(8, 256)
    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
    return (values @ bits).ravel()


@F.arrow_udf(T.LongType())
def simhash(texts: pa.Array) -> pa.Array:
    """Fingerprint as a signed 64-bit number."""
    found = [fingerprint_of(t) for t in texts.cast(pa.large_binary()).to_pylist()]
    return pa.array(np.array(found, np.uint64).view(np.int64))


def hex_digits(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def syndrome(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator."""
    left = words.astype(np.int64)
    for bit in range(22, 10, -1):
        left = np.where(left >> bit & 1, left ^ (GENERATOR << (bit - 11)), left)
    return left


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """By syndrome: the error pattern of weight three or less, and the codewords to add for the others near.

    At distance three from its codeword, a word has five more codewords at distance four: those that
    differ from the first by a codeword of weight seven which covers the three errors.
    """
    error = np.zeros(2048, np.int64)
    near = np.zeros((2048, 6), np.int64)
    for weight in (1, 2, 3):
        patterns = np.array([sum(1 << b for b in bits) for bits in combinations(range(23), weight)])
        error[syndrome(patterns)] = patterns
    data = np.arange(4096) << 11
    codewords = data ^ syndrome(data)
    sevens = codewords[np.bitwise_count(codewords) == 7]
    for s in np.flatnonzero(np.bitwise_count(error) == 3):
        near[s, 1:] = sevens[(sevens & error[s]) == error[s]]
    return error, near


def codeword_indices(words: np.ndarray, tables: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """For each 23-bit word, the indices of all codewords within distance four: one or six, padded by the first."""
    error, near = tables
    s = syndrome(words)
    return ((words ^ error[s])[:, None] ^ near[s]) >> 11


@F.arrow_udf(T.ArrayType(T.LongType()))
def golay_keys(fingerprints: pa.Array) -> pa.Array:
    """All keys of a fingerprint: untouched segment, and codewords near the next one."""
    bits = fingerprints.to_numpy(zero_copy_only=False).view(np.uint64)
    parts = [(bits >> np.uint64(at) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]
    tables = golay_tables()
    keys = [
        ((np.int64(i) << 40) | (parts[i] << 12))[:, None] | codeword_indices(parts[(i + 1) % 3], tables) for i in range(3)
    ]
    return pa.array([sorted(set(row)) for row in np.concatenate(keys, axis=1).tolist()], pa.list_(pa.int64()))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(fingerprints: DataFrame, fp: str = "fp", bits: int = 2, bucket: int = BUCKET) -> DataFrame:
    """Links ``(a, b)`` that connect whatever a chain of steps of at most two bits connects.

    ``fingerprints`` are distinct. Keys that up to ``bucket`` fingerprints share are joined with themselves
    and each pair verified. The members of larger keys are grouped by all words at distance one or less
    instead: two that differ in two bits or less share such a word, any two that share one differ in two
    bits or less, and at most 65 can share it. So a link to the group's smallest replaces all pairs.
    """
    if bits != 2:
        raise ValueError("keys and neighbours are made for two differing bits")
    keys = stored(fingerprints.select(F.col(fp).alias("fp"), F.explode(golay_keys(fp)).alias("key")), "golay-keys")
    sizes = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stored(keys.join(sizes, "key"), "golay-shared")
    small = shared.filter(F.col("n") <= bucket).select("key", "fp")
    near = (F.col("l.fp") < F.col("r.fp")) & (distance(F.col("l.fp"), F.col("r.fp")) <= bits)
    pairs = small.alias("l").join(small.alias("r"), (F.col("l.key") == F.col("r.key")) & near)
    pairs = pairs.select(F.col("l.fp").alias("a"), F.col("r.fp").alias("b")).distinct()
    crowded = shared.filter(F.col("n") > bucket).select("fp").distinct()
    steps = F.array(F.lit(0).cast("long"), *(F.lit(np.uint64(1 << i).astype(np.int64).item()) for i in range(64)))
    words = crowded.select("fp", F.explode(F.transform(steps, lambda s: F.col("fp").bitwiseXOR(s))).alias("word"))
    groups = words.groupBy("word").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    stars = groups.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b").distinct()
    return pairs.union(stars)


def min_hashes(hashes: np.ndarray, count: int, seed: int) -> np.ndarray:
    """``count`` MinHash values of a set that is not empty."""
    rng = np.random.default_rng(seed)
    factors, summands = rng.integers(0, 1 << 64, (2, count, 1), np.uint64)
    least = np.full(count, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 512):
        block = (factors | np.uint64(1)) * hashes[at : at + 512] + summands
        least = np.minimum(least, block.min(1))
    return least


def band_keys_of(hashes: np.ndarray, level: int = 0) -> tuple[list[int], bytes]:
    """Keys of the bands of a level, signed, and the sketch: the last bit of each of the MinHash values.

    Level 0 has ``BANDS`` bands of ``BAND_ROWS`` values; bands of later levels are longer and of values of their own.
    """
    bands, rows = (FURTHER_BANDS if level else BANDS), BAND_ROWS << level
    least = min_hashes(hashes, bands * rows, SEED + level)
    keys = [xxhash.xxh64_intdigest(band.tobytes(), seed) for seed, band in enumerate(least.reshape(bands, rows))]
    # The last bits of products by odd factors follow the set's; higher ones are mixed.
    bits = np.packbits((least >> np.uint64(40)).astype(np.uint8) & 1)
    return np.array(keys, np.uint64).view(np.int64).tolist(), bits.tobytes()[:16].ljust(16, b"\0")


WIDE_TYPE = T.StructType().add("n", T.IntegerType()).add("keys", T.ArrayType(T.LongType())).add("s0", T.LongType()).add("s1", T.LongType())


@F.arrow_udf(WIDE_TYPE)
def wide_keys(texts: pa.Array) -> pa.Array:
    """Number of distinct wide shingles, band keys and sketch of their set; null and blank texts have no keys."""
    sets = [np.unique(shingle_hashes(t, WIDE)) for t in texts.cast(pa.large_binary()).to_pylist()]
    made = [band_keys_of(x) if len(x) else ([], bytes(16)) for x in sets]
    sketches = np.frombuffer(b"".join(m[1] for m in made), "<i8").reshape(-1, 2)
    keys = pa.array([m[0] for m in made], pa.list_(pa.int64()))
    columns = [pa.array([len(x) for x in sets], pa.int32()), keys, pa.array(sketches[:, 0].copy()), pa.array(sketches[:, 1].copy())]
    return pa.StructArray.from_arrays(columns, ["n", "keys", "s0", "s1"])


@F.arrow_udf(T.BinaryType())
def shingle_set(texts: pa.Array) -> pa.Array:
    """The sorted set of wide shingle hashes, eight bytes each."""
    return pa.array([np.unique(shingle_hashes(t, WIDE)).tobytes() for t in texts.cast(pa.large_binary()).to_pylist()], pa.binary())


def further_keys(sets: Column, level: int) -> Column:
    """Keys of a level from stored sets."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def keys(column: pa.Array) -> pa.Array:
        return pa.array([band_keys_of(np.frombuffer(x, "<u8"), level)[0] for x in column.to_pylist()], pa.list_(pa.int64()))

    return keys(sets)


@F.arrow_udf(T.BooleanType())
def similar(left: pa.Array, right: pa.Array) -> pa.Array:
    """Whether two sets of shingle hashes have a Jaccard similarity of 4/5 or more."""
    found = []
    for a, b in zip(left.to_pylist(), right.to_pylist()):
        a, b = np.frombuffer(a, "<u8"), np.frombuffer(b, "<u8")
        both = len(np.intersect1d(a, b, assume_unique=True))
        found.append(both > 0 and 5 * both >= 4 * (len(a) + len(b) - both))
    return pa.array(found, pa.bool_())


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows of ``pairs`` (numbers ``a`` and ``b`` of texts) whose sets are similar."""
    sides = [sets.select(F.col("tid").alias(c), F.col("set").alias(f"set_{c}")) for c in "ab"]
    both = stored(pairs.join(sides[0], "a"), "similar-left").join(sides[1], "b")
    checked = both.select(*pairs.columns, similar("set_a", "set_b").alias("is_similar"))
    return stored(checked.filter("is_similar").drop("is_similar"), "similar-pairs")


def _sets_of(docs: DataFrame, text: str, needed: DataFrame) -> DataFrame:
    """``(tid, set)`` of the texts whose numbers are ``needed``."""
    body = F.col(f"`{text}`")
    texts = docs.select(F.xxhash64(body).alias("tid"), body.alias("body"))
    texts = texts.groupBy("tid").agg(F.first("body").alias("body"))  # copies meet once a task, not in one
    return stored(texts.join(needed, "tid").select("tid", shingle_set("body").alias("set")), "shingle-sets")


def similar_links(prints: DataFrame, docs: DataFrame, text: str = "text", bucket: int = WIDE_BUCKET) -> DataFrame:
    """Links ``(a, b)`` of fingerprints that connect texts with a Jaccard similarity of 4/5 or more.

    ``prints`` has ``fp``, ``tid`` (the text's hash) and ``wide`` of each row. Texts that share a band's key are
    candidates, those within two bits excepted, which :func:`links` connects; pairs whose sizes or sketches rule
    out 4/5 are not compared. Under a key of more than ``bucket`` texts all are compared with the least one, and
    two that it links are connected. Members that it does not link stay open: they and the other texts of their
    key get new keys, from longer bands, and so on until no crowded key has an open member. Texts of a key that
    long are much alike, so few stay open; no level joins a crowd with itself, and rows grow with the texts.
    """
    own = ["tid", "fp", "n", "s0", "s1"]
    part = lambda x, c: F.col(f"{x}.{c}")
    near = lambda a, b: distance(part(a, "fp"), part(b, "fp")) <= 2
    fits = lambda a, b: 5 * F.least(part(a, "n"), part(b, "n")) >= 4 * F.greatest(part(a, "n"), part(b, "n"))
    apart = lambda a, b: sum((distance(part(a, c), part(b, c)) for c in ("s0", "s1")), F.lit(0))
    worth = lambda a, b: ~near(a, b) & fits(a, b) & (apart(a, b) <= SKETCH_APART)
    ends = lambda a, b: [part(x, c).alias(f"{n}{s}") for c, n in (("tid", ""), ("fp", "fp_")) for x, s in ((a, "a"), (b, "b"))]
    texts = prints.groupBy("tid").agg(F.first("fp").alias("fp"), F.first("wide").alias("wide")).select("tid", "fp", "wide.*")
    members = texts.select(*own, F.lit(True).alias("open"), F.explode("keys").alias("key"))
    found, sets, level = [], None, 0
    while True:
        members = stored(members, "band-keys")
        least = F.min(F.struct(*own)).alias("least")
        sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.max("open").alias("any_open"), least)
        shared = stored(members.join(sizes.filter("members > 1 AND any_open").drop("any_open"), "key"), "band-shared")
        if sets is None:
            sets = _sets_of(docs, text, shared.select("tid").distinct())
        small = shared.filter(F.col("members") <= bucket).select("key", "open", *own)
        open_pair = (part("l", "key") == part("r", "key")) & (part("l", "tid") < part("r", "tid")) & (part("l", "open") | part("r", "open"))
        pairs = small.alias("l").join(small.alias("r"), open_pair & worth("l", "r")).select(*ends("l", "r"))
        crowd = shared.filter(F.col("members") > bucket).select("key", "least", F.struct(*own).alias("own"))
        tried = crowd.filter(worth("least", "own")).select(*ends("least", "own"))
        linked = _verified(stored(pairs.union(tried).distinct(), "similar-candidates"), sets)
        found.append(linked.select(F.col("fp_a").alias("a"), F.col("fp_b").alias("b")))
        known = linked.select(F.col("a").alias("least_tid"), F.col("b").alias("own_tid"))
        is_known = (F.col("least.tid") == F.col("least_tid")) & (F.col("own.tid") == F.col("own_tid"))
        left = stored(crowd.filter(~near("least", "own")).join(known, is_known, "left_anti").select("key", "own.tid"), "open-members")
        if left.isEmpty():
            return reduce(DataFrame.union, found).distinct()
        again = crowd.join(left.select("key").distinct(), "key", "left_semi").select("own.*").distinct()
        is_open = left.select(F.col("tid").alias("open_tid")).distinct()
        again = again.join(is_open, F.col("tid") == F.col("open_tid"), "left").withColumn("open", F.col("open_tid").isNotNull())
        level += 1
        keyed = stored(again.drop("open_tid"), "open-texts").join(sets, "tid").withColumn("keys", further_keys(F.col("set"), level))
        members = keyed.select(*own, "open", F.explode("keys").alias("key"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fp, root, component_id)`` for every row of ``docs``.

    ``fp`` is the fingerprint, ``component_id`` the smallest id that links reach (null where all ids are
    null), ``root`` the smallest fingerprint of the component. Texts are read once; equal fingerprints are
    one node, so copies cost one aggregation with partial sums. Null, empty and blank texts have
    fingerprint 0 and are linked like any other. Other columns are ignored. Repeated rows are returned as
    often as they occur; an empty table gives an empty result.
    """
    prints = docs.select(F.col(doc_id).alias("doc_id"), simhash(F.col(text)).alias("fp"))
    return _grouped(stored(prints, "fingerprints"))


def _grouped(prints: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """Add ``root`` and ``component_id`` to stored rows that have ``doc_id`` and ``fp``; ``more`` has further links."""
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    found = links(nodes) if more is None else links(nodes).union(more)
    parts = stored(components(found).withColumnRenamed("node", "fp"), "components")
    placed = nodes.join(parts, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = stored(placed.groupBy("root").agg(F.min("least").alias("component_id")), "component-ids")
    placed = stored(placed.select("fp", "root"), "placed").join(ids, "root")
    return prints.join(stored(placed, "memberships"), "fp")


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", wide: bool = False) -> DataFrame:
    """``docs`` with one row of each component: the smallest id, nulls last, then the smallest row hash.

    Rows equal in all columns are told apart by nothing, so any one of them stays. All columns are kept.
    With ``wide``, texts of a five-word Jaccard similarity of 0.8 or more are linked besides those within two bits.
    """
    row_hash = F.xxhash64(*(F.col(f"`{c}`") for c in docs.columns))
    body = F.col(f"`{text}`")
    columns = [F.col(f"`{doc_id}`").alias("doc_id"), simhash(body).alias("fp"), row_hash.alias("row_hash")]
    if wide:
        columns += [F.xxhash64(body).alias("tid"), wide_keys(body).alias("wide")]
    prints = stored(docs.select(*columns), "fingerprints")
    rows = _grouped(prints, similar_links(prints, docs, text) if wide else None)
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row_hash")
    first = rows.groupBy("root").agg(F.min(order).alias("row"))
    first = stored(first.select(F.col("row.doc_id").alias("kept_id"), F.col("row.row_hash").alias("kept_hash")).distinct(), "kept-rows")
    marked = packed(docs, doc_id=doc_id).withColumn("row_hash", F.xxhash64(*(F.col(f"_row.`{c}`") for c in docs.columns)))
    kept = marked.join(first, (F.col("row_hash") == F.col("kept_hash")) & F.col("doc_id").eqNullSafe(F.col("kept_id")))
    copy = F.row_number().over(Window.partitionBy("kept_hash", "kept_id").orderBy(F.lit(1)))
    return unpacked(kept.withColumn("copy", copy).filter("copy = 1"))

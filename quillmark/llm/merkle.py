"""A manifest of a dataset as Merkle trees: one per source, and one over the sources.

Nodes of a tree are numbered from 0 on. At each level the digests of a run of 16 neighbours are hashed to
their parent. Fixed-offset ``lag`` and ``lead`` columns, masked by a node's slot in its run and by the run's
length, bring each node its siblings; the first child of each run hashes the parent. Windows span blocks of
whole runs, so a source that holds most of the rows is dealt over many tasks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmark.llm.text import stored

FANOUT = 16
BLOCK = 8  # runs in one window
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def field(value: Column) -> Column:
    """A value with its length in front, so that neighbours cannot run together; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(values: list[Column]) -> Column:
    return digest(F.concat(*map(field, values)))


def numbered(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """Stored ``rows`` with ``idx``, the place in their tree by ``order`` (nulls first), and ``n``, the tree's size.

    ``rows`` are distinct in ``tree`` and ``order`` and stand for ``copies`` equal ones each. They are dealt by
    ranges of tree and order; sums per range give each its first number, so no task sees a whole tree.
    """
    keys = [F.col(c).asc_nulls_first() for c in (tree, *order)]
    dealt = stored(rows.repartitionByRange(*keys).withColumn("_range", F.spark_partition_id()), "merkle-ranges")
    sums = dealt.groupBy(tree, "_range").agg(F.sum("copies").alias("_sum"))
    earlier = Window.partitionBy(tree).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(tree)
    sums = sums.select(
        F.col(tree).alias("_tree"), F.col("_range").alias("_at"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_sum").over(whole).alias("n"),
    )
    within = Window.partitionBy("_range", tree).orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("_within", F.coalesce(F.sum("copies").over(within), F.lit(0)))
    placed = placed.join(sums, (F.col("_range") == F.col("_at")) & F.col(tree).eqNullSafe(F.col("_tree")))
    first = F.col("_before") + F.col("_within")
    each = placed.withColumn("idx", F.explode(F.sequence(first, first + F.col("copies") - 1)))
    return each.drop("_range", "_at", "_tree", "_before", "_within", "copies")


def with_siblings(nodes: DataFrame, tree: str, value: str = "digest") -> DataFrame:
    """Add ``left`` and ``right``, the joined digests of the run's nodes before and after each node."""
    slot = F.col("idx") % FANOUT
    run_length = F.least(F.lit(FANOUT), F.col("n") - (F.col("idx") - slot))
    block = F.floor(F.col("idx") / (FANOUT * BLOCK))
    window = Window.partitionBy(tree, "_block").orderBy("idx")
    steps = range(1, FANOUT)
    before = [F.when(slot >= k, F.lag(value, k).over(window)) for k in reversed(steps)]
    after = [F.when(slot + k < run_length, F.lead(value, k).over(window)) for k in steps]
    joined = {"left": F.concat_ws("", *before), "right": F.concat_ws("", *after)}
    return nodes.withColumn("_block", block).withColumns(joined).drop("_block")


def parents(siblings: DataFrame, tree: str, value: str = "digest") -> DataFrame:
    """The next level: first children hash their runs. Trees of one node are finished and have none."""
    first = siblings.filter((F.col("idx") % FANOUT == 0) & (F.col("n") > 1))
    return first.select(
        tree, F.floor(F.col("idx") / FANOUT).alias("idx"), F.ceil(F.col("n") / FANOUT).alias("n"),
        digest(F.concat(value, "right")).alias(value),
    )


PATH = "array<struct<l:string,r:string>>"


def climb(leaves: DataFrame, tree: str) -> list[DataFrame]:
    """All levels from the leaves (``tree``, ``idx``, ``n``, ``digest``) up, each stored with its siblings.

    The number of levels follows from the largest tree, the one figure that the driver sees.
    """
    most, nodes, levels = leaves.agg(F.max("n")).first()[0] or 0, leaves, []
    while True:
        levels.append(stored(with_siblings(nodes, tree), "merkle-level"))
        if most <= 1:
            return levels
        nodes, most = parents(levels[-1], tree), -(-most // FANOUT)


def tops(levels: list[DataFrame], tree: str) -> DataFrame:
    """``(tree, digest)`` of the last node of each tree."""
    return reduce(DataFrame.union, (level.filter("n = 1").select(tree, "digest") for level in levels))


def with_paths(levels: list[DataFrame], tree: str, above: DataFrame | None = None) -> DataFrame:
    """Leaves with ``path``, the siblings ``(l, r)`` of each level from the leaf on, and ``top``, the tree's last node.

    ``above`` holds the path ``up`` that goes on from each tree's top, if it does. Paths come down level by level, each node
    taking its parent's, so a tree's rows never meet under one key and a leaf is shuffled once.
    """
    over = None if above is None else above.select(F.col(tree).alias("_tree"), F.col("up").alias("path"))
    step = F.array(F.struct(F.col("left").alias("l"), F.col("right").alias("r")))
    path = None
    for level in reversed(levels):
        last = level.filter("n = 1").withColumn("top", F.col("digest")).drop("left", "right")
        if over is None:
            last = last.withColumn("path", F.array().cast(PATH))
        else:
            last = last.join(over, F.col(tree).eqNullSafe(F.col("_tree"))).drop("_tree")
        if path is None:
            path = last
            continue
        higher = path.select(F.col(tree).alias("_tree"), F.col("idx").alias("_idx"), F.col("path").alias("_path"), "top")
        is_parent = F.col(tree).eqNullSafe(F.col("_tree")) & (F.floor(F.col("idx") / FANOUT) == F.col("_idx"))
        inner = level.filter("n > 1").join(higher, is_parent).withColumn("path", F.concat(step, "_path"))
        path = inner.select(*last.columns).union(last)
    return path


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Digests of every row: ``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    Leaves hash the ``fields``. Within a source (null: one of its own, first) they ascend by id, null ids first,
    ties by digest; rows equal in both are equal leaves, each with its own place. Tampering lower-cases A-Z in the
    text of rows whose id's crc32 is divisible by 5, never of null ids. ``folded_root`` is worked out from the
    tampered leaf and the original siblings, ``verified`` says whether it is the root. Other columns are ignored;
    an empty table gives no rows. Texts are read once and only digests are moved.
    """
    col = lambda c: F.col(f"`{c}`")
    tampered = [F.translate(col(c), UPPER, LOWER) if c == text else col(c) for c in fields]
    touched = F.coalesce(F.crc32(col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
    rows = docs.select(
        col(source).alias("source"), col(doc_id).alias("doc_id"), leaf_digest([col(c) for c in fields]).alias("digest"),
        F.when(touched, leaf_digest(tampered)).alias("tampered"),
    )
    # The tampered digest belongs to the leaf: equal ids and leaves have equal ones.
    distinct = stored(rows, "merkle-leaves").groupBy("source", "doc_id", "digest").agg(
        F.count(F.lit(1)).alias("copies"), F.first("tampered").alias("tampered")
    )
    levels = climb(stored(numbered(distinct, "source", ["doc_id", "digest"]), "merkle-numbered"), "source")
    subroots = tops(levels, "source").select(F.lit(0).alias("tree"), "source", "digest", F.lit(1).cast("long").alias("copies"))
    sources = climb(stored(numbered(stored(subroots, "merkle-subroots"), "tree", ["source"]), "merkle-sources"), "tree")
    above = with_paths(sources, "tree").select("source", F.col("path").alias("up"))
    rows = with_paths(levels, "source", stored(above, "merkle-above")).withColumn("_root", tops(sources, "tree").select("digest").scalar())
    start = F.coalesce("tampered", "digest")
    fold = F.aggregate("path", start, lambda d, s: digest(F.concat(s["l"], d, s["r"])))
    proof = F.concat_ws("", F.transform("path", lambda s: F.concat(s["l"], s["r"])))
    made = rows.select(
        "doc_id", F.col("digest").alias("leaf"), F.col("top").alias("subroot"), F.col("_root").alias("root"),
        digest(proof).alias("proof_sha256"), fold.alias("folded_root"),
    )
    return made.withColumn("verified", F.col("folded_root") == F.col("root"))

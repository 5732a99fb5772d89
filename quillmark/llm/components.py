"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.llm.text import stored


def _state(edges: DataFrame) -> tuple:
    """Number of links and a checksum: equal for equal link sets."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _nearest(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of each node, combined in each task before the shuffle."""
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _star(edges: DataFrame, larger_only: bool) -> DataFrame:
    """One contraction. Every node hangs its larger (or its smaller) neighbours to the smallest one.

    The minimum per node is stored before it is joined, so both sides of the join are plain exchanges
    and Spark can split a hub's rows.
    """
    links = _both_ways(edges) if larger_only else edges
    least = stored(_nearest(links).select("u", F.least("u", "m").alias("m")), "star-min")
    joined = links.join(least, "u")
    if larger_only:
        moved = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        own = least.select("u", F.col("m").alias("v"))
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(own)
    return moved.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node with a link to another; ``root`` is the smallest node reachable.

    Each round contracts paths to larger and then to smaller neighbours; the number of rounds grows with
    the logarithm of the longest path. Rounds are stored in the shared folder, so a lost executor costs
    a re-read. The driver sees one count and checksum per round. Nulls and loops are ignored; an empty
    table gives an empty one.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    edges = stored(edges, "links")
    state = _state(edges)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        edges = stored(_star(stored(_star(edges, True), "star-large"), False), "star-small")
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.groupBy("v").agg(F.count(F.lit(1)).alias("n")).select(F.col("v").alias("node"), F.col("v").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)

"""Deterministic train / validation / test split."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmark.operators.ranking import running_totals, value_slices
from quillmark.operators.summaries import LABEL
from quillmark.sources.scratch import stored

SPLITS = ("train", "val", "test")
FRACTIONS = (0.70, 0.15, 0.15)


def hash_fraction(key, seed: int = 42) -> Column:
    """Number in [0, 1) that depends on the key and the seed alone."""
    digest = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") / F.lit(2.0**32)


def stratified_split(
    df: DataFrame,
    key: str,
    label: str = LABEL,
    fractions: tuple[float, ...] = FRACTIONS,
    seed: int = 42,
    names: tuple[str, ...] = SPLITS,
) -> DataFrame:
    """Add ``split``; rows of other classes than 0 and 1 are dropped.

    The hash of a row's key decides alone, so each class is split in the given proportions, a row
    keeps its split however the data is partitioned, and nothing is shuffled.
    """
    position = hash_fraction(key, seed)
    split, limit = F.lit(names[-1]), sum(fractions[:-1])
    for name, fraction in reversed(list(zip(names[:-1], fractions[:-1]))):
        split = F.when(position < limit, name).otherwise(split)
        limit -= fraction
    return df.filter(F.col(label).isin(0, 1)).withColumn("split", split)


def exact_split(
    df: DataFrame,
    key: str,
    label: str = LABEL,
    fractions: tuple[float, ...] = FRACTIONS,
    seed: int = 42,
    names: tuple[str, ...] = SPLITS,
    path: str | None = None,
) -> DataFrame:
    """``(key, label, split)`` with exact proportions: of a class of n rows, split k ends at row ``round(f_k n)``.

    The products are decimals and halves are rounded up: 0.7 of 45 rows is 31.5, so 32, and not 31.499... as in doubles.

    Rows stand in the order of their key's hash, ties by key. Places are running totals over ranges of the
    hash, so a class is never one task. Keys are distinct; a row without one is dropped, as are other
    classes than 0 and 1. Rows that repeat a key and its label are one row. Even a class of three rows has them in
    the splits that rounding gives. The input is evaluated twice, once for the ranges' limits and once
    for one exchange of narrow rows that all else reads; with ``path``, these rows are stored there and it is evaluated once.
    """
    rows = df.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull()).groupBy(key, label).agg(F.max(F.lit(1)).alias("n"))
    rows = rows if path is None else stored(rows, path)
    sliced = value_slices(rows.withColumn("value", hash_fraction(key, seed)))
    placed = running_totals(sliced, [label], "slice", F.struct("value", key), {"place": "n"})
    sizes = sliced.groupBy(F.col(label).alias("_label")).agg(F.sum("n").alias("size"))
    joined = placed.join(sizes, F.col(label) == F.col("_label"))
    shares = [Decimal(repr(round(fraction, 9))) for fraction in fractions[:-1]]
    split = F.lit(names[-1])
    for k in reversed(range(len(shares))):
        split = F.when(F.col("place") < F.round(F.col("size") * F.lit(sum(shares[: k + 1]))), names[k]).otherwise(split)
    return joined.select(key, label, split.alias("split"))


def split_sizes(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows per split and class."""
    return df.groupBy("split", label).agg(F.count(F.lit(1)).alias("n"))

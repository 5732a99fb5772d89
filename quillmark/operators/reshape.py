"""Reshaping, labelling, filtering and inspection of text tables."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HUMAN = 1
GENERATED = 0


def melt_texts(df: DataFrame, suffix: str = "_abstract", ids: list[str] | None = None) -> DataFrame:
    """Wide to long: one row per text column, as ``(*ids, category, text)``. Null texts stay."""
    values = [c for c in df.columns if c.endswith(suffix)]
    if not values:
        raise ValueError(f"no column ends with {suffix!r}: {df.columns}")
    return df.unpivot(list(ids or []), values, "category", "text")


def tag_subset(df: DataFrame, name: str) -> DataFrame:
    """Add the provenance column ``subset``."""
    return df.withColumn("subset", F.lit(name))


def union_subsets(dfs: list[DataFrame]) -> DataFrame:
    """Union by column name."""
    if not dfs:
        raise ValueError("no subset to union")
    return reduce(DataFrame.unionByName, dfs)


def encode_label(df: DataFrame, human: str = "original_abstract", column: str = "category") -> DataFrame:
    """Add ``category_encode``: 1 for the human category, 0 for every other."""
    return df.withColumn("category_encode", F.when(F.col(column) == human, HUMAN).otherwise(GENERATED))


def drop_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows with a value in every listed column."""
    return df.dropna(subset=list(cols))


def computed(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column that is computed once per row, even if it is filtered on later.

    A filter on a plain computed column is pushed below it, where the whole expression is evaluated
    a second time. It cannot pass the generator that makes this column.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def drop_empty(df: DataFrame, column: str = "processed_text") -> DataFrame:
    """Rows whose text is not empty."""
    return df.filter(F.length(column) > 0)


def filter_class(df: DataFrame, label: int, column: str = "category_encode") -> DataFrame:
    """Rows of one class; the comparison reaches the Parquet scan."""
    return df.filter(F.col(column) == label)


def text_preview(c, n: int = 100) -> Column:
    """First ``n`` characters."""
    return F.substring(c, 1, n)


def prediction_view(df: DataFrame, label: str = "true_label") -> DataFrame:
    """The fixed output columns of a scored table, batch or stream."""
    return df.select(
        F.current_timestamp().alias("processed_at"),
        text_preview("text").alias("text_preview"),
        F.col(label).cast("int").alias("true_label"),
        F.col("prediction").cast("int").alias("predicted_label"),
        vector_to_array("probability")[HUMAN].alias("p_human"),
        "short_words_ratio",
        "total_physical_lines",
        "foreign_letters_count",
    )


def schema_table(df: DataFrame) -> DataFrame:
    """Position, name and type of each column. Reads no data."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, column_name string, data_type string")


def column_table(df: DataFrame) -> DataFrame:
    """:func:`schema_table` with the known and the distinct values of each column, counted in one scan.

    Values are reduced to 64-bit hashes within each task, so no text is shuffled; the hashes of a column
    are counted apart from those of the others.
    """
    rows = df.select(
        F.explode(
            F.array(*(F.struct(F.lit(i).alias("position"), F.when(F.col(c).isNotNull(), F.xxhash64(c)).alias("h")) for i, c in enumerate(df.columns)))
        ).alias("cell")
    ).select("cell.*")
    distinct = rows.groupBy("position", "h").agg(F.count("h").alias("n"))
    counts = distinct.groupBy("position").agg(F.sum("n").alias("n_known"), F.count("h").alias("n_distinct"))
    none = F.coalesce(F.col("n_known"), F.lit(0).cast("long")), F.coalesce(F.col("n_distinct"), F.lit(0).cast("long"))
    joined = schema_table(df).join(counts, "position", "left")
    return joined.withColumns({"n_known": none[0], "n_distinct": none[1]})


def preview(df: DataFrame, cols: list[str], order: str, n: int = 3) -> DataFrame:
    """First ``n`` rows by ``order``; the order makes it repeatable."""
    return df.orderBy(order).limit(n).select(*cols)


def require_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """The listed columns of ``df``, or an error that names the missing ones."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; found {df.columns}")
    return df.select(*cols)

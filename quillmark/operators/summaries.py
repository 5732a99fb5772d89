"""Class, subset and feature summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillmark.operators.ranking import quantiles_by_group
from quillmark.operators.reshape import GENERATED, HUMAN

LABEL = "category_encode"


def _n():
    return F.count(F.lit(1))


def class_distribution(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows per class."""
    return df.groupBy(label).agg(_n().alias("n"))


def subset_distribution(df: DataFrame, subset: str = "subset", label: str = LABEL) -> DataFrame:
    """Rows per subset and class, sorted."""
    return df.groupBy(subset, label).agg(_n().alias("n")).orderBy(subset, label)


def subset_class_pivot(df: DataFrame, subset: str = "subset", label: str = LABEL) -> DataFrame:
    """Subset x class counts, 0 where there is none."""
    return df.groupBy(subset).agg(
        F.count_if(F.col(label) == GENERATED).alias("n_generated"), F.count_if(F.col(label) == HUMAN).alias("n_human")
    )


def class_share(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rows and percentage per class. The window spans one row per class."""
    share = F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy())
    return class_distribution(df, label).withColumn("percent", share)


def feature_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum, one row per feature."""
    values = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {values}) as (feature, value)")
    return long.groupBy("feature").agg(
        F.count("value").alias("n"),
        F.mean("value").alias("mean"),
        F.stddev_samp("value").alias("stddev"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )


# Feature, name of its mean, decimals: the columns of the published per-class table.
CLASS_MEANS = (
    ("short_words_ratio", "mean_short_ratio", 4),
    ("total_physical_lines", "mean_lines", 2),
    ("foreign_letters_count", "mean_foreign_cnt", 2),
    ("foreign_letters_ratio", "mean_foreign_ratio", 4),
    ("active_voice_count", "mean_active_voice", 2),
    ("redundancy_score", "mean_redundancy", 4),
)


def feature_means_by_class(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Rounded feature means and rows per class."""
    means = (F.round(F.mean(c), digits).alias(name) for c, name, digits in CLASS_MEANS)
    return df.groupBy(label).agg(*means, _n().alias("n_samples"))


def feature_quartiles_by_class(
    df: DataFrame,
    cols: tuple[str, ...] = ("short_words_ratio", "total_physical_lines", "foreign_letters_count"),
    label: str = LABEL,
) -> DataFrame:
    """Exact quartiles of each feature per class, one row per class and feature."""
    known = df.filter(F.col(label).isNotNull())
    long = quantiles_by_group(known, label, list(cols))
    at = lambda p: F.max(F.when(F.col("prob") == p, F.col("value")))
    return long.groupBy(label, "feature").agg(at(0.25).alias("q1"), at(0.5).alias("q2"), at(0.75).alias("q3"))


def class_shift(df: DataFrame, cols: list[str], label: str = LABEL) -> DataFrame:
    """Mean of each feature per class and the relative change from human to generated, in percent."""
    values = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = df.selectExpr(f"`{label}` AS label", f"stack({len(cols)}, {values}) as (feature, value)")
    means = long.groupBy("feature").agg(
        F.mean(F.when(F.col("label") == HUMAN, F.col("value"))).alias("mean_human"),
        F.mean(F.when(F.col("label") == GENERATED, F.col("value"))).alias("mean_generated"),
    )
    change = F.try_divide(F.col("mean_generated") - F.col("mean_human"), F.col("mean_human")) * 100
    return means.withColumn("change_percent", change)


def ttr_by_class(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Document-mean and pooled type-token ratio per class, from :func:`~quillmark.functions.ttr_columns`."""
    sums = df.groupBy(label).agg(
        F.avg("doc_ttr").alias("ttr_doc_mean"),
        F.sum("unique_tokens").alias("total_unique"),
        F.sum("token_count").alias("total_tokens"),
        _n().alias("n_docs"),
    )
    pooled = F.coalesce(F.try_divide("total_unique", "total_tokens"), F.lit(0.0))
    return sums.withColumn("ttr_pooled", pooled)


def ttr_histogram(df: DataFrame, bins: int = 40, label: str = LABEL, value: str = "doc_ttr") -> DataFrame:
    """Equal-width histogram of a value per class, over each class's own range.

    Rows become counts per distinct value first, so the texts behind the values are read once: the
    range of a class and its bins both come from those counts. A class without spread gets a range
    of half a unit to either side.
    """
    counts = (
        df.select(label, F.col(value).cast("double").alias("v"))
        .filter(F.col("v").isNotNull())
        .groupBy(label, "v")
        .agg(_n().alias("n"))
    )
    # Reading `n` keeps this aggregate on the counts: without it Spark would go back to the texts.
    seen = F.when(F.col("n") > 0, F.col("v"))
    low, high = F.min(seen), F.max(seen)
    ranges = counts.groupBy(F.col(label).alias("_class")).agg(
        F.when(low == high, low - 0.5).otherwise(low).alias("low"),
        F.when(low == high, high + 0.5).otherwise(high).alias("high"),
    )
    step = (F.col("high") - F.col("low")) / bins
    position = F.floor((F.col("v") - F.col("low")) / (F.col("high") - F.col("low")) * bins)
    return (
        counts.join(ranges, F.col(label).eqNullSafe(F.col("_class")))
        .select(label, F.least(position, F.lit(bins - 1)).cast("int").alias("bin"), "low", step.alias("step"), "n")
        .groupBy(label, "bin", (F.col("low") + F.col("step") * F.col("bin")).alias("bin_start"))
        .agg(F.sum("n").alias("n"))
    )

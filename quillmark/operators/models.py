"""Classifiers and their training."""

from __future__ import annotations

import math
import time

from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillmark.operators import boosting
from quillmark.operators.reshape import HUMAN
from quillmark.operators.summaries import LABEL

FEATURES = "features"
STYLO_FEATURES = "features_stylo"


def logistic_regression(features: str = FEATURES, label: str = LABEL, **params) -> LogisticRegression:
    return LogisticRegression(
        featuresCol=features, labelCol=label, **{"maxIter": 50, "regParam": 0.01, "elasticNetParam": 0.0, **params}
    )


def random_forest(features: str = FEATURES, label: str = LABEL, **params) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol=features, labelCol=label, **{"numTrees": 100, "maxDepth": 10, "seed": 42, **params}
    )


def gradient_boosting(features: str = FEATURES, label: str = LABEL, **params) -> GBTClassifier:
    return GBTClassifier(
        featuresCol=features, labelCol=label, **{"maxIter": 50, "maxDepth": 6, "stepSize": 0.1, "seed": 42, **params}
    )


# Name in reports -> classifier. A `weightCol` may be passed to any of them for unequal classes.
CLASSIFIERS = {
    "LogisticRegression": logistic_regression,
    "RandomForest": random_forest,
    "GBTClassifier": gradient_boosting,
}


# Tree learners keep a bin number per feature: 40 KB a row of 10,008 features, read up to nine times by one task of a boosting step.
TREES = ("RandomForest", "GBTClassifier")
ROWS_PER_TASK = 2_000
# Boosting on more rows than these keeps the entries that differ from zero only; on fewer, its many small jobs take longer than Spark's learner.
DENSE_ROWS = 5_000


def dealt(df: DataFrame, rows: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` in even partitions of about ``rows`` rows at most: a task then reads as much for any size of the table.

    Also where there are enough partitions, for those of files can be uneven.
    """
    parts = math.ceil(df.count() / rows)
    return df.repartition(max(parts, df.rdd.getNumPartitions())) if parts > 1 else df


def train(name: str, df: DataFrame, features: str = FEATURES, **params):
    """Fit a classifier on a feature table and return it with the seconds it took."""
    start = time.monotonic()
    learner = CLASSIFIERS[name](features, **params)
    if boosting.supports(learner, params) and df.count() > DENSE_ROWS:
        model = boosting.fit(learner, df)
    else:
        model = learner.fit(dealt(df) if name in TREES else df)
    return model, time.monotonic() - start


def scoring_pipeline(feature_model: PipelineModel, classifier, invalid: str = "error") -> PipelineModel:
    """One pipeline from style measures and processed text to a prediction.

    Measures are never null, so no row can be invalid here. Skipping invalid rows would add a filter
    on all measures, which Spark pushes below them and thereby computes each of them twice. Pass
    ``invalid="skip"`` to score stored measures that may have gaps. Only the assembler that the
    classifier reads is kept.
    """
    wanted = classifier.getFeaturesCol()
    stages = []
    for stage in feature_model.stages:
        if not isinstance(stage, VectorAssembler):
            stages.append(stage)
        elif stage.getOutputCol() == wanted:
            stages.append(stage.copy().setHandleInvalid(invalid))
    return PipelineModel(stages=[*stages, classifier])


def score(model: Transformer, df: DataFrame) -> DataFrame:
    """Add the prediction columns and ``score``, the probability of the human class."""
    return model.transform(df).withColumn("score", vector_to_array("probability")[HUMAN])


def scored_runs(models: dict, splits: dict[str, DataFrame], label: str = LABEL) -> DataFrame:
    """``(model, split, label, prediction, score)`` of every model on every split."""
    runs = (
        score(model, df).select(F.lit(name).alias("model"), F.lit(split).alias("split"), label, "prediction", "score")
        for name, model in models.items()
        for split, df in splits.items()
    )
    first, *rest = runs
    for run in rest:
        first = first.unionByName(run)
    return first

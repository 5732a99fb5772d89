"""From a processed corpus to an evaluated, saved pipeline."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmark.functions.stylometry import STYLO_COLUMNS
from quillmark.operators.evaluation import choose_model, confusion_matrix, metrics_table, model_comparison
from quillmark.operators.features import NUM_FEATURES, feature_pipeline
from quillmark.operators.models import CLASSIFIERS, FEATURES, scored_runs, scoring_pipeline, train
from quillmark.operators.splits import SPLITS, stratified_split
from quillmark.operators.summaries import LABEL
from quillmark.sources.artifacts import save_model
from quillmark.sources.files import write_report
from quillmark.sources.scratch import stored

FEATURE_COLUMNS = ("processed_text", *STYLO_COLUMNS, "tfidf_features", "features_stylo", "features")


@dataclass
class FeatureTables:
    """The fitted feature stages and where the feature table lies, partitioned by split."""

    model: PipelineModel
    path: str
    spark: SparkSession

    @property
    def root(self) -> str:
        """The folder above the feature table."""
        return self.path.rsplit("/", 1)[0]

    def measures(self) -> DataFrame:
        """Style measures and processed texts of all splits, as they were stored before the feature stages."""
        return self.spark.read.parquet(f"{self.root}/measures").drop("split")

    def split(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path).filter(F.col("split") == name).drop("split")


def build_features(
    df: DataFrame, path: str, key: str, seed: int = 42, num_features: int = NUM_FEATURES, keep: tuple[str, ...] = ()
) -> FeatureTables:
    """Split a table with style measures, fit the feature stages on its training part, write features.

    The measures are computed once and written by split; fitting and transforming read them back,
    so neither repeats the text work and a lost executor costs no more than a file read.
    """
    spark = df.sparkSession
    measures = f"{path}/measures"
    columns = [*dict.fromkeys([*keep, LABEL, "processed_text", *STYLO_COLUMNS])]
    split = stratified_split(df, key, seed=seed).select(*columns, "split")
    split.write.mode("overwrite").partitionBy("split").parquet(measures)
    table = spark.read.parquet(measures)
    model = feature_pipeline(num_features).fit(table.filter(F.col("split") == SPLITS[0]))
    features = model.transform(table).select(*dict.fromkeys([*keep, LABEL, *FEATURE_COLUMNS]), "split")
    features.write.mode("overwrite").partitionBy("split").parquet(f"{path}/features")
    return FeatureTables(model, f"{path}/features", spark)


def train_all(
    tables: FeatureTables,
    names: tuple[str, ...] = tuple(CLASSIFIERS),
    features: str = FEATURES,
    params: dict[str, dict] | None = None,
    trained: dict[str, tuple] | None = None,
) -> tuple[dict, DataFrame]:
    """Fit classifiers one after the other; return the models and the metrics of val and test.

    Metrics are ``(model, split, metric, value)``, with the training time as a metric of ``train``.
    Every model scores every split once: the scores are stored next to the features, and metrics and
    confusion matrices are worked out from them and stored as well (see :func:`evaluation_report`).
    The training split is not cached: each classifier reads the stored features and keeps its own
    compact form of them while it learns. ``trained`` holds classifiers that are fitted on these tables
    already, by name, each with its seconds.
    """
    spark, known = tables.spark, trained or {}
    training = tables.split("train").select(LABEL, features)
    fit = lambda name: train(name, training, features, **(params or {}).get(name, {}))
    fitted = {name: known.get(name) or fit(name) for name in names}
    models = {name: model for name, (model, _) in fitted.items()}
    held_out = {s: tables.split(s).select(LABEL, features) for s in ("val", "test")}
    runs = stored(scored_runs(models, held_out), f"{tables.root}/scores", ("model", "split"))
    times = spark.createDataFrame(
        [(name, "train", "train_time_s", float(seconds)) for name, (_, seconds) in fitted.items()],
        "model string, split string, metric string, value double",
    )
    stored(confusion_matrix(runs, keys=("model", "split")), f"{tables.root}/confusion")
    return models, stored(metrics_table(runs).unionByName(times), f"{tables.root}/metrics")


def evaluation_report(tables: FeatureTables) -> dict[str, DataFrame]:
    """What :func:`train_all` stored: scores, metrics, confusion matrices, the best model and the comparison."""
    read = lambda name: tables.spark.read.parquet(f"{tables.root}/{name}")
    metrics = read("metrics")
    return {
        "scores": read("scores"),
        "metrics": metrics,
        "confusion": read("confusion"),
        "best": choose_model(metrics),
        "comparison": model_comparison(metrics),
    }


def save_best(tables: FeatureTables, models: dict, metrics: DataFrame, path: str) -> str:
    """Save the full pipeline of the model with the best validation F1; return its name."""
    best = choose_model(metrics).first()["model"]
    save_model(scoring_pipeline(tables.model, models[best]), path)
    return best


def save_all(tables: FeatureTables, models: dict, metrics: DataFrame, path: str) -> str:
    """Save every model's pipeline below ``path`` by name, the best one again as ``best``, and the report.

    The report holds metrics, confusion matrices and the best model as JSON lines in ``report``.
    """
    for name, model in models.items():
        save_model(scoring_pipeline(tables.model, model), f"{path}/{name}")
    best = save_best(tables, models, metrics, f"{path}/best")
    report = evaluation_report(tables)
    for name in ("metrics", "confusion", "best", "comparison"):
        write_report(report[name], f"{path}/report/{name}")
    return best

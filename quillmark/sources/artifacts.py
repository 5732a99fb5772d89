"""Saved models."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def save_model(model: PipelineModel, path: str) -> None:
    """Save a fitted pipeline, features and classifier together, over what is there."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a saved pipeline; it knows the classes of its stages."""
    return PipelineModel.load(path)

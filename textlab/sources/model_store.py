"""Saving and loading fitted pipelines, with the names of their features."""

from __future__ import annotations


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str):
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)


def feature_names(model) -> list[str]:
    """The feature columns a saved model expects, in training order."""
    assembler = next(s for s in model.stages if hasattr(s, "getInputCols"))
    return [name.removeprefix("_scaled_") for name in assembler.getInputCols()]

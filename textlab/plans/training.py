"""Train and evaluate a classifier."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.operators.classify import (
    accuracy, classification_report, feature_importance, predict, train_classifier,
)
from textlab.operators.sampling import split_flag
from textlab.sources.model_store import save_model


@dataclass
class TrainingResult:
    model: object
    predictions: DataFrame      # all rows with is_test, quality and confidence
    accuracy: DataFrame         # one row for train, one for test
    report: DataFrame           # classification report of the test rows
    importance: DataFrame       # largest five


def train_and_evaluate(
    df: DataFrame, features: Sequence[str], label: str, key: Sequence[str],
    test: float = 0.2, seed: int = 42, path: str | None = None, exact_split: bool = True, **forest,
) -> TrainingResult:
    """Stratified split, scaling fitted on the training rows, forest, evaluation; saved if ``path`` is given."""
    flagged = split_flag(df.select(*key, label, *features), [label], key, test, seed, exact_split)
    model = train_classifier(flagged.filter(~F.col("is_test")), features, label, seed=seed, **forest)
    if path:
        save_model(model, path)
    named = flagged.withColumnRenamed(label, "_actual")
    predictions = predict(model, named).withColumnsRenamed({"_actual": "actual"})
    part = predictions.withColumn("part", F.when(F.col("is_test"), "test").otherwise("train"))
    return TrainingResult(
        model,
        predictions,
        accuracy(part, "actual", "quality", "part"),
        classification_report(predictions.filter("is_test"), "actual", "quality"),
        feature_importance(df.sparkSession, model),
    )

"""Validate and score batches of records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from textlab.operators.classify import predict
from textlab.operators.report import batch_results, batch_summary
from textlab.operators.validation import Rule, validate_ranges


def validate_and_score(
    model, records: DataFrame, rules: Sequence[Rule], batch: str = "batch_id", order: Sequence[str] = ("position",)
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(numbered results, summary per batch, rejected records with their reasons)."""
    valid, rejected = validate_ranges(records, rules)
    results = batch_results(predict(model, valid), batch, order)
    return results, batch_summary(results, batch), rejected

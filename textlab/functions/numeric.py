"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def finite_or_zero(value: Column | str) -> Column:
    """NaN, infinities and null become 0.0."""
    c = (F.col(value) if isinstance(value, str) else value).cast("double")
    return F.when(c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(0.0)).otherwise(c)


def share_percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; null when there is no whole."""
    return F.try_divide(part * F.lit(100.0), whole)

"""Range validation of input rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Rule = tuple[str, float, float]


def with_errors(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Add ``errors``: the features that are missing, not a number, or outside their inclusive bounds."""

    def broken(feature: str, low: float, high: float):
        inside = F.col(feature).between(F.lit(low), F.lit(high))
        return F.when(~F.coalesce(inside, F.lit(False)), F.lit(feature))

    return df.withColumn("errors", F.array_compact(F.array(*[broken(*rule) for rule in rules])))


def validate_ranges(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their ``errors``)."""
    checked = with_errors(df, rules)
    return checked.filter(F.size("errors") == 0).drop("errors"), checked.filter(F.size("errors") > 0)

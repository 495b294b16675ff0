"""The five comparison queries over a table with a group, a section, a date and a text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.operators.profile import top_groups


def filter_contains(df: DataFrame, column: str, part: str) -> DataFrame:
    """Rows whose value contains ``part``, case-sensitive; nulls are not kept."""
    return df.filter(F.col(column).contains(part))


def sort_ascending(df: DataFrame, column: str, *tie: str) -> DataFrame:
    """All rows in ascending order, nulls first. ``tie`` columns also let a very frequent value be
    spread over several ranges."""
    return df.orderBy(F.asc_nulls_first(column), *tie)


def chain_top(df: DataFrame, section: int, column: str = "name", k: int = 10) -> DataFrame:
    """Filter one section, count per value, keep the ``k`` largest counts."""
    return top_groups(df.filter(F.col("section") == section), column, k)

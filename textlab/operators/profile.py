"""Corpus profile operators: shape, distinct and missing counts, top groups, length statistics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.functions.text import char_count


def shape(df: DataFrame) -> DataFrame:
    """One row: total_rows, total_columns, column_names (comma separated)."""
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        "total_rows",
        F.lit(len(df.columns)).cast("long").alias("total_columns"),
        F.lit(",".join(df.columns)).alias("column_names"),
    )


def distinct_with_null(column: str, approx: bool = False) -> Column:
    """Distinct count in which null is one more value."""
    counted = F.approx_count_distinct(column) if approx else F.count_distinct(F.col(column))
    return counted + F.coalesce(F.max(F.col(column).isNull().cast("int")), F.lit(0))


def unpivot_row(df: DataFrame, name: str, value: str) -> DataFrame:
    """One wide row of counters into (name, value) rows."""
    return df.unpivot([], df.columns, name, value)


def unique_counts(df: DataFrame, columns: Sequence[str], approx: bool = False) -> DataFrame:
    """(column_name, unique_count) for scalar columns, one scan for all of them."""
    wide = df.agg(*[distinct_with_null(c, approx).cast("long").alias(c) for c in columns])
    return unpivot_row(wide, "column_name", "unique_count")


def unique_exploded(df: DataFrame, column: str, approx: bool = False) -> DataFrame:
    """The same for the elements of a list column; an empty or null list counts as a null element."""
    elements = df.select(F.explode_outer(column).alias(column))
    return unique_counts(elements, [column], approx)


def group_count(df: DataFrame, column: str, count_name: str = "n") -> DataFrame:
    """Rows per value, the null value included."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(count_name))


def top_groups(
    df: DataFrame, column: str, k: int, count_name: str = "n", weight: str | None = None
) -> DataFrame:
    """The ``k`` most frequent values; equal counts are ordered by value. ``weight`` is a row count
    per input row, for tables that were counted before."""
    rows = F.sum(weight) if weight else F.count(F.lit(1))
    counted = df.groupBy(column).agg(rows.alias(count_name))
    return counted.orderBy(F.desc(count_name), F.asc_nulls_first(column)).limit(k)


def first_distinct(df: DataFrame, column: str, k: int = 10) -> DataFrame:
    return df.select(column).distinct().orderBy(F.asc_nulls_first(column)).limit(k)


def date_range(df: DataFrame, column: str) -> DataFrame:
    """Earliest and latest date as strings."""
    return df.agg(
        F.min(column).cast("string").alias("earliest"), F.max(column).cast("string").alias("latest")
    )


def length_histogram(df: DataFrame, text: str) -> DataFrame:
    """(chars, n): as many rows as there are different lengths."""
    return df.groupBy(char_count(text).alias("chars")).agg(F.count(F.lit(1)).alias("n"))


def text_stats(df: DataFrame, text: str) -> DataFrame:
    """Mean, median, minimum and maximum length, all taken from the length histogram."""
    known = length_histogram(df, text).filter("chars is not null")
    return known.agg(
        F.try_divide(F.sum(F.col("chars") * F.col("n")).cast("double"), F.sum("n").cast("double")).alias("avg_length"),
        F.percentile("chars", 0.5, F.col("n")).alias("median_length"),
        F.min("chars").cast("long").alias("min_length"),
        F.max("chars").cast("long").alias("max_length"),
    )


def avg_length(df: DataFrame, text: str) -> DataFrame:
    return df.agg(F.avg(char_count(text)).alias("avg_length"))


def null_counts(columns: Sequence[str]) -> Mapping[str, Column]:
    return {c: F.count_if(F.col(f"`{c}`").isNull()) for c in columns}


def missing_data(df: DataFrame) -> DataFrame:
    """(column_name, n_missing) for the columns that have nulls."""
    wide = df.agg(*[n.alias(c) for c, n in null_counts(df.columns).items()])
    return unpivot_row(wide, "column_name", "n_missing").filter("n_missing > 0")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n) for each table."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionByName(other)
    return result

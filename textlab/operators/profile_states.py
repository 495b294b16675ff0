"""Mergeable states of a corpus profile: one scan gives counts that add up with those of other data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.functions.text import char_count

KEYS = ["kind", "item", "value"]


def profile_states(df: DataFrame, counted: Sequence[str], date: str, text: str) -> DataFrame:
    """``(kind, item, value, n, low, high)`` by one aggregation over grouping sets, combined before its shuffle.

    ``rows`` has the number of rows, ``missing`` the nulls of each column, ``dates`` the first and last date as strings,
    ``values`` the rows of every value of the ``counted`` columns (null is a value) and ``length`` those of every text length.
    No rows give no states.
    """
    counted = list(dict.fromkeys(counted))
    groups = [f"_v{i}" for i in range(len(counted))] + ["_chars"]
    flags = {c: F.col(f"`{c}`").isNull().cast("long").alias(f"_m{i}") for i, c in enumerate(df.columns)}
    slim = df.select(
        *[F.col(f"`{c}`").cast("string").alias(g) for c, g in zip(counted, groups)], char_count(text).cast("string").alias("_chars"),
        F.col(f"`{date}`").cast("string").alias("_date"), *flags.values())
    whole = 2 ** len(groups) - 1
    sets = slim.groupingSets([[g] for g in groups] + [[]], *groups).agg(
        F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("n"), F.min("_date").alias("low"), F.max("_date").alias("high"),
        *[F.sum(f"_m{i}").alias(f"_m{i}") for i in range(len(flags))])
    none = F.lit(None).cast("string")

    def state(kind: str, item: Column | str | None = None, value: Column = none, n: Column | None = None, low: Column = none, high: Column = none) -> Column:
        item = none if item is None else F.lit(item) if isinstance(item, str) else item
        n = F.lit(None).cast("long") if n is None else n
        return F.struct(F.lit(kind).alias("kind"), item.alias("item"), value.alias("value"), n.alias("n"), low.alias("low"), high.alias("high"))

    totals = [state("rows", n=F.col("n")), state("dates", low=F.col("low"), high=F.col("high"))]
    totals += [state("missing", c, n=F.col(f"_m{i}")) for i, c in enumerate(df.columns)]
    made = F.when(F.col("_set") == whole, F.array(*totals))
    for i, (name, group) in enumerate(zip([*counted, None], groups)):
        one = state("values", name, F.col(group), F.col("n")) if name else state("length", value=F.col(group), n=F.col("n"))
        made = made.when(F.col("_set") == whole - (1 << (len(groups) - 1 - i)), F.array(one))
    return sets.select(F.inline(made))


def merged(*states: DataFrame) -> DataFrame:
    """The states of all the data together."""
    all_ = states[0]
    for other in states[1:]:
        all_ = all_.unionByName(other)
    return all_.groupBy(*KEYS).agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


def scalars(states: DataFrame, columns: Sequence[str], distinct: Sequence[str]) -> DataFrame:
    """One row: ``rows``, ``unique <column>``, ``earliest``, ``latest`` and ``missing <column>``."""
    kind, item = F.col("kind"), F.col("item")
    total = lambda where: F.coalesce(F.sum(F.when(where, F.col("n"))), F.lit(0)).cast("long")
    return states.agg(
        total(kind == "rows").alias("rows"),
        *[F.count_if((kind == "values") & (item == c)).alias(f"unique {c}") for c in distinct],
        F.min("low").alias("earliest"), F.max("high").alias("latest"),
        *[total((kind == "missing") & (item == c)).alias(f"missing {c}") for c in columns])


def text_statistics(states: DataFrame) -> DataFrame:
    """Mean, median, minimum and maximum length; nulls without texts."""
    lengths = states.where("kind = 'length' and value is not null").select(F.col("value").cast("long").alias("chars"), "n")
    return lengths.agg(
        F.try_divide(F.sum(F.col("chars") * F.col("n")).cast("double"), F.sum("n").cast("double")).alias("avg_length"),
        F.percentile("chars", 0.5, F.col("n")).alias("median_length"), F.min("chars").alias("min_length"), F.max("chars").alias("max_length"))


def top_values(states: DataFrame, column: str, kind: str, k: int, count_name: str = "n") -> DataFrame:
    """The ``k`` most frequent values of a counted column of type ``kind``; equal counts are ordered by value, null first."""
    own = states.where((F.col("kind") == "values") & (F.col("item") == column))
    values = own.select(F.col("value").cast(kind).alias(column), F.col("n").alias(count_name))
    return values.orderBy(F.desc(count_name), F.asc_nulls_first(column)).limit(k)

"""Positions inside ordered groups, without putting a hot group into one task."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlab.operators.sizing import small_side
from textlab.session import ensure_checkpoint_dir

HOT_ROWS = 1_000_000
HOT_BYTES = 256 << 20  # text of a group that one task may hold
RANGE_CHARS = 256      # characters of a text by which rows are dealt to ranges


def hot_groups(
    df: DataFrame, keys: Sequence[str], limit: int = HOT_ROWS, max_bytes: int = HOT_BYTES
) -> DataFrame | None:
    """Groups with more than ``limit`` rows or ``max_bytes`` of text as ``(_group, _rows, _bytes)``; None when there are none.

    Rows and the bytes of all text columns are summed before the shuffle; few groups come back, as each
    holds that many rows or bytes.
    """
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)).cast("long") for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    size = sum(texts[1:], texts[0]) if texts else F.lit(0).cast("long")
    hot = (
        df.groupBy(F.struct(*keys).alias("_group"))
        .agg(F.count(F.lit(1)).alias("_rows"), F.sum(size).alias("_bytes"))
        .filter((F.col("_rows") > limit) | (F.col("_bytes") > max_bytes))
    )
    side = small_side(hot)
    return None if side.isEmpty() else side


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary groups, rows of hot groups); null keys match each other."""
    tagged = df.withColumn("_group", F.struct(*keys))
    groups = hot.select("_group")
    return (
        tagged.join(groups, "_group", "left_anti").drop("_group"),
        tagged.join(groups, "_group", "left_semi").drop("_group"),
    )


def window_positions(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``_pos`` (from 0) and ``_n`` (group size) by one shuffle on ``keys``."""
    group = Window.partitionBy(*keys)
    return df.withColumns({
        "_pos": F.row_number().over(group.orderBy(*order)).cast("long") - 1,
        "_n": F.count(F.lit(1)).over(group),
    })


def blocked_positions(df: DataFrame, keys: Sequence[str], order: Sequence[str], blocks: int) -> DataFrame:
    """The same columns for groups of any size.

    Rows are range-partitioned on ``keys + order``, up to the first characters of the first text in
    ``order``, so that no long text is sampled to the driver; a row's position is its rank inside its range
    plus the number of rows of the group in earlier ranges. The ranges are checkpointed, because
    both sides of that sum must see the same boundaries.
    """
    ensure_checkpoint_dir(df.sparkSession)
    ranged = (
        df.repartitionByRange(blocks, *keys, *_range_key(df, order))
        .withColumns({"_block": F.spark_partition_id(), "_group": F.struct(*keys)})
        .checkpoint()
    )
    earlier = Window.partitionBy("_group").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_group", "_block")
        .agg(F.count(F.lit(1)).alias("_in_block"))
        .select(
            "_group",
            "_block",
            F.coalesce(F.sum("_in_block").over(earlier), F.lit(0)).alias("_before"),
            F.sum("_in_block").over(Window.partitionBy("_group")).alias("_n"),
        )
    )
    inside = Window.partitionBy("_group", "_block").orderBy(*order)
    return (
        ranged.withColumn("_rank", F.row_number().over(inside).cast("long"))
        .join(small_side(offsets), ["_group", "_block"])
        .withColumn("_pos", F.col("_before") + F.col("_rank") - 1)
        .drop("_group", "_block", "_before", "_rank")
    )


def _range_key(df: DataFrame, order: Sequence[str]) -> list[Column]:
    """Columns that sort like ``order`` but may tie where it does not: a text is cut, and nothing follows it."""
    key = []
    for name in order:
        if isinstance(df.schema[name].dataType, T.StringType):
            return [*key, F.substring(name, 1, RANGE_CHARS)]
        key.append(F.col(name))
    return key


def block_count(df: DataFrame, hot: DataFrame, hot_rows: int, hot_bytes: int = HOT_BYTES) -> int:
    """Enough ranges that none holds much more than ``hot_rows`` rows or ``hot_bytes`` of text."""
    rows, size = hot.agg(F.sum("_rows"), F.sum("_bytes")).first()
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), ceil((rows or 0) / hot_rows), ceil((size or 0) / hot_bytes))


def positions(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], hot_rows: int = HOT_ROWS, hot_bytes: int = HOT_BYTES
) -> DataFrame:
    """Add ``_pos`` and ``_n`` per group of ``keys``; groups above ``hot_rows`` rows or ``hot_bytes`` of text are ranked in blocks."""
    hot = hot_groups(df, keys, hot_rows, hot_bytes)
    if hot is None:
        return window_positions(df, keys, order)
    ordinary, large = split_hot(df, keys, hot)
    return window_positions(ordinary, keys, order).unionByName(
        blocked_positions(large, keys, order, block_count(df, hot, hot_rows, hot_bytes))
    )

"""Overlapping chunks of neighbouring sentences, with long chunks split at sentence boundaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlab.operators.enrich import with_section_name
from textlab.operators.ranking import HOT_BYTES, HOT_ROWS, block_count, blocked_positions, hot_groups, split_hot
from textlab.operators.sizing import small_side

META = ["name", "reportDate", "cik", "section_priority"]


def _is_tail(pos: Column, n: Column, w: int, stride: int) -> Column:
    """The window start after the last full window of a group, if sentences are left for it."""
    return (pos % stride == 0) & (pos > n - w) & (pos - stride <= n - w) & (pos - stride + w < n)


def _windows(
    df: DataFrame, keys: list[str], order: list[str], text: str, w: int, stride: int, keep_tail: bool
) -> DataFrame:
    """Chunks of ordinary groups by one shuffle: each kept row leads a chunk and looks ahead."""
    group = Window.partitionBy(*keys)
    ordered = group.orderBy(*order)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ahead = [F.col(text)] + [F.lead(text, i).over(ordered) for i in range(1, w)]
    pos, n = F.col("_pos"), F.col("_n")
    return (
        df.select(
            *keys,
            F.row_number().over(ordered).cast("long").alias("_rank"),
            F.count(F.lit(1)).over(whole).alias("_n"),
            F.array(*ahead).alias("_ahead"),
            *[F.first(m).over(whole).alias(m) for m in META],
        )
        .withColumn("_pos", F.col("_rank") - 1)
        .filter(((pos % stride == 0) & (pos <= n - w)) | ((pos == 0) & (n < w)) | (F.lit(keep_tail) & _is_tail(pos, n, w, stride)))
        .select(
            *keys, *META, pos.alias("_start"), n,
            F.slice("_ahead", 1, F.least(n - pos, F.lit(w)).cast("int")).alias("_texts"),
        )
    )


def _windows_of_hot(
    df: DataFrame, keys: list[str], order: list[str], text: str, w: int, stride: int, blocks: int, keep_tail: bool
) -> DataFrame:
    """Chunks of groups too large for one task: rank in blocks, send each row to its chunks."""
    placed = blocked_positions(df, keys, order, blocks)
    pos, n = F.col("_pos"), F.col("_n")
    last_start = F.when(n < w, F.lit(0)).otherwise(n - w)
    starts = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.lit((w - 1) // stride)),
            lambda i: (F.floor(pos / stride).cast("long") - i) * stride,
        ),
        lambda s: (s >= 0) & (s > pos - w) & ((s <= last_start) | (F.lit(keep_tail) & _is_tail(s, n, w, stride))),
    )
    gathered = (
        placed.select(*keys, n, pos, text, F.explode(starts).alias("_start"))
        .groupBy(*keys, "_n", "_start")
        .agg(F.sort_array(F.collect_list(F.struct(pos, F.col(text).alias("_text")))).alias("_parts"))
        .select(*keys, "_n", "_start", F.col("_parts._text").alias("_texts"), F.struct(*keys).alias("_group"))
    )
    heads = placed.filter(pos == 0).select(F.struct(*keys).alias("_group"), *META)
    return gathered.join(small_side(heads), "_group").select(*keys, *META, "_start", "_n", "_texts")


def pack(texts: Column, max_chars: int) -> Column:
    """Greedy packing in order: a text joins the current part while the two lengths together stay
    below ``max_chars`` (the joining space is not counted); a longer text is a part of its own."""
    empty = F.struct(F.array().cast("array<string>").alias("done"), F.lit("").alias("cur"))

    def step(acc: Column, text: Column) -> Column:
        done, cur = acc["done"], acc["cur"]
        fits = F.length(cur) + F.length(text) < max_chars
        joined = F.when(cur == "", text).otherwise(F.concat(cur, F.lit(" "), text))
        flushed = F.when(fits | (cur == ""), done).otherwise(F.concat(done, F.array(cur)))
        return F.struct(flushed.alias("done"), F.when(fits, joined).otherwise(text).alias("cur"))

    return F.aggregate(
        texts, empty, step,
        lambda acc: F.when(acc["cur"] == "", acc["done"]).otherwise(F.concat(acc["done"], F.array(acc["cur"]))),
    )


def chunks(
    df: DataFrame,
    sections: DataFrame,
    text: str = "sentence",
    order: Sequence[str] = ("sentenceID",),
    w: int = 3,
    stride: int = 2,
    max_chars: int = 2000,
    hot_rows: int | None = HOT_ROWS,
    hot_bytes: int = HOT_BYTES,
    keep_tail: bool = True,
) -> DataFrame:
    """One row per chunk of each ``(docID, section)`` group.

    Groups of fewer than ``w`` sentences are one chunk; otherwise windows of ``w`` start at 0,
    ``stride``, ... up to the last full window. Sentences after it make a shorter chunk of their own;
    without ``keep_tail`` they are in no chunk. Equal order
    values are ordered by text. Groups above ``hot_rows`` rows or ``hot_bytes`` of text are spread over tasks; ``hot_rows=None`` skips
    that check for inputs whose groups are known to be small.
    """
    keys, by = ["docID", "section"], [*order, text]
    hot = hot_groups(df, keys, hot_rows, hot_bytes) if hot_rows else None
    if hot is None:
        windows = _windows(df, keys, by, text, w, stride, keep_tail)
    else:
        ordinary, large = split_hot(df, keys, hot)
        windows = _windows(ordinary, keys, by, text, w, stride, keep_tail).unionByName(
            _windows_of_hot(large, keys, by, text, w, stride, block_count(df, hot, hot_rows, hot_bytes), keep_tail)
        )
    return _chunk_records(windows, sections, w, max_chars)


def _chunk_records(windows: DataFrame, sections: DataFrame, w: int, max_chars: int) -> DataFrame:
    whole = F.col("_n") < w
    too_long = F.col("char_count") > max_chars
    name = F.concat(
        F.coalesce(F.col("docID").cast("string"), F.lit("None")),
        F.lit("_sec"),
        F.coalesce(F.col("section").cast("string"), F.lit("None")),
        F.when(whole, F.lit("_full")).otherwise(F.concat(F.lit("_chunk"), F.col("_start").cast("string"))),
    )
    built = (
        windows.withColumn("text", F.array_join("_texts", " "))
        .withColumn("char_count", F.length("text"))
        .withColumn("_size", F.size("_texts"))
        .withColumn("_split", ~whole & too_long)
        .withColumn("_parts", F.when(F.col("_split"), pack(F.col("_texts"), max_chars)).otherwise(F.array("text")))
        .drop("text", "char_count", "_texts")
    )
    # a chunk always has a part; the outer form keeps the packing out of an inferred pre-filter
    parts = built.select("*", F.posexplode_outer("_parts").alias("_part", "text")).drop("_parts")
    named = with_section_name(parts, sections)
    return named.select(
        F.when(F.col("_split"), F.concat(name, F.lit("_part"), F.col("_part").cast("string")))
        .otherwise(name).alias("chunk_id"),
        "text", "docID", "section", "section_name",
        F.col("name").alias("company"),
        "reportDate", "cik",
        F.col("section_priority").alias("priority"),
        F.col("_size").cast("int").alias("n_sentences"),
        F.length("text").alias("char_count"),
        F.when(~whole, F.col("_split")).alias("is_split"),
    )


def chunk_stats(chunked: DataFrame) -> DataFrame:
    """One row: number of chunks, character statistics, number of split parts; nulls when empty."""
    return chunked.agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.min("char_count").cast("long").alias("min_chars"),
        F.max("char_count").cast("long").alias("max_chars"),
        F.avg("char_count").alias("avg_chars"),
        F.count_if("is_split").alias("n_split"),
    )

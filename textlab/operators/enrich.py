"""Sentence enrichment: counts, quality flags, section priority."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.functions import text as tx
from textlab.operators.sampling import sample_n
from textlab.schemas import UNUSED_SENTENCE_COLUMNS


def text_features(df: DataFrame, text: str = "sentence") -> DataFrame:
    """Add char_count, word_count and avg_word_length."""
    return df.withColumns({
        "char_count": tx.char_count(text),
        "word_count": tx.word_count(text),
        "avg_word_length": tx.avg_word_length(text),
    })


def lookup(df: DataFrame, dimension: DataFrame, key: str, value: str, name: str, default) -> DataFrame:
    """Left outer lookup of ``dimension.value`` by ``key``; unknown keys get ``default`` (a Column).

    No hint: the planner broadcasts a dimension whose size it knows to be below its threshold.
    """
    side = dimension.select(F.col(key).alias("_key"), F.col(value).alias("_value"))
    return (
        df.join(side, F.col(key) == F.col("_key"), "left")
        .withColumn(name, F.coalesce("_value", default))
        .drop("_key", "_value")
    )


def with_priority(df: DataFrame, sections: DataFrame, name: str = "section_priority") -> DataFrame:
    """Priority of the section; ``unknown`` for codes outside the dimension, null for a null code."""
    return lookup(df, sections, "section", "priority", name,
                  F.when(F.col("section").isNotNull(), F.lit("unknown")))


def with_section_name(df: DataFrame, sections: DataFrame, name: str = "section_name") -> DataFrame:
    """Name of the section; ``Section_<code>`` for codes outside the dimension."""
    code = F.coalesce(F.col("section").cast("string"), F.lit("None"))
    return lookup(df, sections, "section", "name", name, F.concat(F.lit("Section_"), code))


def enrich(
    df: DataFrame,
    sections: DataFrame,
    min_tokens: int = 3,
    sample_size: int | None = None,
    key: Sequence[str] = ("docID", "sentenceID"),
    seed: int = 42,
    unicode: bool = False,
    text: str = "sentence",
) -> DataFrame:
    """Drop unused columns, add counts, flags and priority, keep texts of at least ``min_tokens``,
    then draw ``sample_size`` of them (by default all)."""
    rows = df.drop(*UNUSED_SENTENCE_COLUMNS).filter(tx.word_count(text) >= min_tokens)
    rows = sample_n(rows, sample_size, key, seed)
    flagged = rows.withColumns({
        "token_count": tx.word_count(text),
        "char_count": tx.char_count(text),
        "is_long_text": tx.is_long_text(text),
        "is_fragment": tx.is_fragment(text),
        "likely_table": tx.likely_table(text, unicode),
    })
    return with_priority(flagged, sections)

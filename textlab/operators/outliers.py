"""Contamination cut and outlier reports over any score column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.functions.numeric import finite_or_zero, share_percent
from textlab.functions.text import preview
from textlab.operators.enrich import text_features
from textlab.operators.order_statistics import exact_quantile

FEATURES = ["char_count", "word_count", "avg_word_length"]


def outlier_features(df: DataFrame, text: str = "sentence") -> DataFrame:
    """Text features with every missing or infinite value replaced by 0."""
    return text_features(df, text).withColumns({
        "char_count": F.coalesce("char_count", F.lit(0)).cast("long"),
        "word_count": F.coalesce("word_count", F.lit(0)).cast("long"),
        "avg_word_length": finite_or_zero("avg_word_length"),
    })


def threshold(df: DataFrame, score: str, contamination: float, approx: bool = False, weight: str | None = None):
    """The score above which the given share of rows lies; None for an empty input."""
    if approx:
        return df.agg(F.percentile_approx(score, 1 - contamination, 10_000)).first()[0]
    return exact_quantile(df, score, 1 - contamination, weight)


def flag(df: DataFrame, score: str = "score", contamination: float = 0.01, approx: bool = False) -> DataFrame:
    """Add ``is_outlier`` (0/1) and ``anomaly_score``, the score relative to the cut."""
    return flag_above(df, score, threshold(df, score, contamination, approx))


def flag_above(df: DataFrame, score: str, cut: float | None) -> DataFrame:
    limit = F.lit(cut).cast("double")
    return df.withColumn("is_outlier", F.coalesce((F.col(score) > limit).cast("int"), F.lit(0))).withColumn(
        "anomaly_score", F.col(score) - limit
    )


def outlier_summary(flagged: DataFrame, weight: str | None = None) -> DataFrame:
    """One row: sentences, outliers, percentage. ``weight`` is a row count per input row."""
    w = F.col(weight) if weight else F.lit(1).cast("long")
    return flagged.agg(
        F.coalesce(F.sum(w), F.lit(0)).alias("total_sentences"),
        F.coalesce(F.sum(F.when(F.col("is_outlier") == 1, w)), F.lit(0)).alias("outliers_detected"),
    ).withColumn("outlier_percentage", share_percent(F.col("outliers_detected"), F.col("total_sentences")))


def outlier_profile(flagged: DataFrame, weight: str | None = None) -> DataFrame:
    """Characters and words of outliers and of normal rows, one row each."""
    w = F.col(weight) if weight else F.lit(1).cast("long")

    def spread(c: str) -> list[Column]:
        mean = F.try_divide(F.sum(F.col(c) * w).cast("double"), F.sum(w).cast("double"))
        return [
            F.min(c).cast("long").alias(f"min_{c}"), F.max(c).cast("long").alias(f"max_{c}"), mean.alias(f"mean_{c}")
        ]

    return flagged.groupBy("is_outlier").agg(*spread("char_count"), *spread("word_count"))


def outlier_top(flagged: DataFrame, key: Sequence[str], k: int = 10, text: str = "sentence") -> DataFrame:
    """The ``k`` most anomalous outliers with a shortened text; equal scores by key."""
    return (
        flagged.filter(F.col("is_outlier") == 1)
        .orderBy(F.desc("anomaly_score"), *key)
        .limit(k)
        .withColumn(text, preview(text, 200))
    )

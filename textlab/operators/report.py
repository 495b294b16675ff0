"""Presentation operators: feature listings, categories, batch results, timing comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.functions.text import pretty_name
from textlab.operators.ranking import HOT_ROWS, positions
from textlab.schemas import QUALITY_LABELS


def feature_profile(df: DataFrame, ids: Sequence[str], features: Sequence[str]) -> DataFrame:
    """Wide rows to (ids, property, value) with readable property names."""
    wide = df.select(*ids, *[F.col(f).cast("double").alias(f) for f in features])
    return wide.unpivot(list(ids), list(features), "property", "value").withColumn("property", pretty_name("property"))


def with_category(df: DataFrame, quality: str = "quality", labels: Mapping[int, str] = QUALITY_LABELS) -> DataFrame:
    """Add the category label of a quality; ``Unknown`` outside the scale."""
    pairs = [F.lit(x) for item in labels.items() for x in item]
    known = F.try_element_at(F.create_map(*pairs), F.col(quality).cast("int"))
    return df.withColumn("category", F.coalesce(known, F.lit("Unknown")))


def batch_results(
    df: DataFrame, batch: str, order: Sequence[str], quality: str = "quality", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Rows numbered from 1 inside their batch, with the quality and its category."""
    numbered = positions(df, [batch], order, hot_rows).withColumn("sample", F.col("_pos") + 1)
    return with_category(numbered.drop("_pos", "_n"), quality)


def batch_summary(df: DataFrame, batch: str, quality: str = "quality", good: int = 7) -> DataFrame:
    """Per batch: samples, mean quality, samples of at least ``good``."""
    return df.groupBy(batch).agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.avg(quality).alias("average_quality"),
        F.count_if(F.col(quality) >= good).alias("good_samples"),
    )


def ab_summary(
    df: DataFrame, test: str = "test", engine: str = "engine", ms: str = "ms",
    baseline: str = "base", candidate: str = "cand",
) -> DataFrame:
    """Per test: both times, speedup of the candidate, winner; equal times go to the baseline.

    A side without a time stays null, and such a test has no winner.
    """

    def total(name: str):
        return F.sum(F.when(F.col(engine) == name, F.col(ms)))

    times = df.groupBy(test).agg(total(baseline).alias("baseline_ms"), total(candidate).alias("candidate_ms"))
    return times.withColumn("speedup", F.try_divide("baseline_ms", "candidate_ms")).withColumn(
        "winner", F.when(F.col("candidate_ms") < F.col("baseline_ms"), F.lit(candidate))
        .when(F.col("candidate_ms") >= F.col("baseline_ms"), F.lit(baseline))
    )


def ab_totals(summary: DataFrame, baseline: str = "base", candidate: str = "cand") -> DataFrame:
    """One row over all tests that both sides have a time for: total times, overall speedup, wins, verdict.

    A test that lacks a side is in no total; without any other the verdict is null.
    """
    both = F.col("baseline_ms").isNotNull() & F.col("candidate_ms").isNotNull()
    compared = summary.agg(
        F.coalesce(F.sum(F.when(both, F.col("baseline_ms"))), F.lit(0.0)).alias("total_baseline_ms"),
        F.coalesce(F.sum(F.when(both, F.col("candidate_ms"))), F.lit(0.0)).alias("total_candidate_ms"),
        F.count_if(F.col("winner") == candidate).alias("candidate_wins"),
        F.count_if(F.col("winner") == baseline).alias("baseline_wins"),
    )
    return compared.withColumns({
        "overall_speedup": F.try_divide("total_baseline_ms", "total_candidate_ms"),
        "faster": F.when(F.col("candidate_wins") + F.col("baseline_wins") == 0, F.lit(None).cast("string"))
        .when(F.col("total_candidate_ms") < F.col("total_baseline_ms"), F.lit(candidate)).otherwise(F.lit(baseline)),
    })

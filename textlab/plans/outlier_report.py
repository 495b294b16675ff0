"""The outlier report: features, isolation forest, contamination cut, summary tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.operators.forest import fit_isolation_forest
from textlab.operators.order_statistics import nth_values
from textlab.operators.outliers import (
    FEATURES, flag_above, outlier_features, outlier_profile, outlier_summary, outlier_top, threshold,
)
from textlab.session import staged


def outlier_report(
    df: DataFrame,
    key: Sequence[str],
    text: str = "sentence",
    contamination: float = 0.01,
    trees: int = 100,
    psi: int = 256,
    seed: int = 42,
    top: int = 10,
) -> dict[str, DataFrame]:
    """summary, profile, top rows and flagged rows.

    Keys and features are written once, and the forest, the cut and the tables come from them. Equal features have
    equal scores, so the cut needs one row per different feature combination with its count; texts are read again only
    for the flagged rows.
    """
    rows = outlier_features(df, text)
    slim = staged(rows.select(*key, *FEATURES), "features")
    model = fit_isolation_forest(slim, FEATURES, key, trees, psi, seed)
    combinations = staged(model.score(slim.groupBy(*FEATURES).agg(F.count(F.lit(1)).alias("n"))), "combinations")
    cut = threshold(combinations, "score", contamination, weight="n")
    counted = flag_above(combinations, "score", cut)
    flagged = flag_above(model.score(rows), "score", cut)
    return {
        "summary": outlier_summary(counted, "n").withColumns({
            "contamination_rate": F.lit(contamination), "algorithm": F.lit("Isolation Forest"),
        }),
        "profile": outlier_profile(counted, "n"),
        "top": outlier_top(flagged, key, top, text),
        "flagged": flagged,
        "nodes": model.nodes_frame(df.sparkSession),
    }


def first_by_key(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``n`` rows by a unique numeric key: the ``n``-th key is found and the rows are only
    filtered. Rows with a null key come in no order and are left out."""
    df = df.filter(F.col(key).isNotNull())
    if n < 1:
        return df.limit(0)
    total = df.count()
    if total <= n:
        return df
    return df.filter(F.col(key) <= F.lit(nth_values(df, key, [n - 1])[0]))


def quick_report(
    df: DataFrame, key: str, n: int, text: str = "sentence", contamination: float = 0.02, **options
) -> dict[str, DataFrame]:
    """The same report over the first ``n`` rows."""
    return outlier_report(first_by_key(df, key, n), [key], text, contamination, **options)

"""Exact order statistics of a numeric column: a rank sketch brackets them, one exact pass finds them.

The sketch is Spark's mergeable quantile summary (Greenwald and Khanna, SIGMOD 2001), whose ranks are off by at most
``rows / ACCURACY``. Counted rows (``weight``) go through repeated narrowing histograms instead, as that summary takes no weights.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import floor, isinf

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

BINS = 4096
LIST_VALUES = 100_000
ACCURACY = 20_000          # of the sketch; one part in so many of the rows
GRID = 1_000               # equal steps of the sketch that any rank is bracketed by


def _ranked(df: DataFrame, value: str, weight: str | None) -> DataFrame:
    """(v, w): whole numbers stay whole numbers, everything else is a double."""
    whole = isinstance(df.schema[value].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
    rows = df.select(
        F.col(value).cast("long" if whole else "double").alias("v"),
        (F.col(weight) if weight else F.lit(1)).cast("long").alias("w"),
    ).filter(F.col("v").isNotNull())
    return rows if whole else rows.filter(~F.isnan("v"))


def nth_values(df: DataFrame, value: str, ranks: list[int], weight: str | None = None) -> list:
    """The values at the given 0-based ranks of the ascending order; nulls and NaN are not ranked.

    ``weight`` is a row count; with it, each pass is one aggregation to at most 4,096 bins, and a rank's bin
    becomes the next range until the range holds few distinct values.
    """
    rows = _ranked(df, value, weight)
    if weight:
        return _select(rows, rows.agg(F.min("v"), F.max("v"), F.sum("w")).first(), ranks)
    sketch = rank_sketch(rows)
    _check(sketch["n"], ranks)
    return _between(rows, sketch, ranks)


def rank_sketch(rows: DataFrame, near: Sequence[float] = ()) -> dict:
    """``n`` and the sketch of the values at equal steps and on both sides of the shares ``near``, in one job without a shuffle."""
    shares = sorted({i / GRID for i in range(GRID + 1)} | {min(max(p + d / ACCURACY, 0.0), 1.0) for p in near for d in (-2, 2)})
    seen = Observation()
    points = F.percentile_approx("v", shares, ACCURACY).alias("points")
    rows.observe(seen, F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), points).write.format("noop").mode("overwrite").save()
    found = seen.get
    return {"n": found["n"] or 0, "low": found["low"], "high": found["high"], "shares": shares, "points": found["points"] or []}


def _bracket(sketch: dict, rank: int) -> tuple:
    """Values between which the value at ``rank`` lies for certain."""
    n, slack = sketch["n"], sketch["n"] / ACCURACY + 1
    low = [v for p, v in zip(sketch["shares"], sketch["points"]) if p * n + slack <= rank]
    high = [v for p, v in zip(sketch["shares"], sketch["points"]) if p * n - slack >= rank + 1]
    return (max(low) if low else sketch["low"]), (min(high) if high else sketch["high"])


def _between(rows: DataFrame, sketch: dict, ranks: list[int]) -> list:
    """The values at ``ranks``, given a sketch of ``rows`` (whole numbers that a double does not hold are narrowed by histograms): rows below their bracket are counted and those inside listed
    with their counts in one pass; a bracket of very many rows is narrowed by a sketch of its own."""
    if isinstance(sketch["low"], int) and max(-sketch["low"], sketch["high"]) >= 2**53:
        return _select(rows, (sketch["low"], sketch["high"], sketch["n"]), ranks)
    if isinf(float(sketch["low"])) or isinf(float(sketch["high"])):
        raise ValueError("order statistics need finite values")
    groups: list[tuple] = []
    for rank in sorted(set(ranks)):
        low, high = _bracket(sketch, rank)
        if groups and low <= groups[-1][1]:
            groups[-1] = (groups[-1][0], max(high, groups[-1][1]), [*groups[-1][2], rank])
        else:
            groups.append((low, high, [rank]))
    found: dict[int, float] = {}
    for low, high, own in groups:
        if low == high:
            found.update(dict.fromkeys(own, low))
            continue
        within = (sum(1 for p in sketch["points"] if low < p < high) + 2) * sketch["n"] / GRID
        if within > LIST_VALUES and (low, high) != (sketch["low"], sketch["high"]):
            under = rows.where(F.col("v") < F.lit(low)).count()
            inner = rows.where(F.col("v").between(low, high))
            found.update(zip(own, _between(inner, rank_sketch(inner), [r - under for r in own])))
            continue
        inside = F.when(F.col("v") >= F.lit(low), F.col("v"))
        counted = rows.where(F.col("v") <= F.lit(high)).groupBy(inside.alias("v")).agg(F.count(F.lit(1)).alias("n")).collect()
        counted.sort(key=lambda r: (r["v"] is not None, r["v"] or 0))
        upto = 0
        for r in counted:
            found.update(dict.fromkeys([k for k in own if upto <= k < upto + r["n"] and r["v"] is not None], r["v"]))
            upto += r["n"]
    return [found[r] for r in ranks]


def _check(total: int, ranks: list[int]) -> None:
    if not total or any(not 0 <= r < total for r in ranks):
        raise ValueError(f"ranks {ranks} outside 0..{(total or 0) - 1}")


def _select(rows: DataFrame, extent, ranks: list[int]) -> list:
    """The narrowing itself, given the smallest value, the largest value and the row count."""
    low, high, total = extent
    _check(total, ranks)
    if isinf(low) or isinf(high):
        raise ValueError("order statistics need finite values")
    found: dict[int, float] = {}
    pending = [(low, high, 0, total, sorted(set(ranks)))]
    while pending:
        low, high, below, inside, wanted = pending.pop()
        if low == high:
            found.update(dict.fromkeys(wanted, low))
            continue
        part = rows.filter(F.col("v").between(low, high))
        if inside <= LIST_VALUES:
            counted = part.groupBy("v").agg(F.sum("w").alias("n")).orderBy("v").select("v", "v", "n")
        else:
            # whole numbers are subtracted as such where that cannot overflow: doubles would lose digits
            if isinstance(low, int) and high - low < 2**62:
                scaled = (F.col("v") - F.lit(low)).cast("double") / F.lit(float(high - low))
            else:
                # halves, because the distance between two finite doubles may not be finite
                scaled = (F.col("v").cast("double") / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2)
            slot = F.least(F.floor(scaled * F.lit(float(BINS))).cast("long"), F.lit(BINS - 1))
            counted = (
                part.groupBy(slot.alias("slot"))
                .agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.sum("w").alias("n"))
                .orderBy("slot").select("lo", "hi", "n")
            )
        for lo, hi, n in counted.collect():
            here = [r for r in wanted if below <= r < below + n]
            if here:
                pending.append((lo, hi, below, n, here))
            below += n
    return [found[r] for r in ranks]


def exact_quantile(df: DataFrame, value: str, p: float, weight: str | None = None) -> float | None:
    """The ``p`` quantile with linear interpolation between neighbours; None for no rows."""
    rows = _ranked(df, value, weight)
    extent = rows.agg(F.min("v"), F.max("v"), F.sum("w")).first() if weight else None
    sketch = None if weight else rank_sketch(rows, [p])
    n = extent[2] if weight else sketch["n"]
    if not n:
        return None
    place = p * (n - 1)
    first = floor(place)
    ranks = [n - 1] if first >= n - 1 else [first, first + 1]
    found = _select(rows, extent, ranks) if weight else _between(rows, sketch, ranks)
    return found[0] + (found[-1] - found[0]) * (place - first) if len(found) > 1 else found[0]

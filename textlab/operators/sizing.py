"""Size checks that come before any broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_SMALL_ROWS = 100_000


def bounded_rows(df: DataFrame, max_rows: int = MAX_SMALL_ROWS) -> DataFrame | None:
    """The rows of ``df`` as a local relation, or None when there are more than ``max_rows``."""
    table = df.limit(max_rows + 1).toArrow()
    if table.num_rows > max_rows:
        return None
    return df.sparkSession.createDataFrame(table, schema=df.schema)


def small_side(df: DataFrame, max_rows: int = MAX_SMALL_ROWS) -> DataFrame:
    """Evaluate a small join side once and mark it for broadcast; beyond the bound return it
    unchanged, so that the join shuffles instead."""
    local = bounded_rows(df, max_rows)
    return df if local is None else F.broadcast(local)

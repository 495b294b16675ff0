"""Tables written to the shared folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``; a local session without that setting gets a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir() + "/textlab-shared"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries run here remove their shuffle files when they end, instead of when the driver collects its garbage. Spark before 4.1 ignores it."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read again: cuts the lineage, survives lost executors and leaves no shuffle files."""
    path = shared_folder(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def set_aside(df: DataFrame, names: Iterable[str]) -> tuple[DataFrame, list[Column]]:
    """``df`` with its columns of these names, in any case, renamed, and what selects all its columns under their own names again."""
    names, prefix = {n.lower() for n in names}, "_own_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix = "_" + prefix
    own = {c: prefix + c for c in df.columns if c.lower() in names}
    return df.withColumnsRenamed(own), [F.col(f"`{own.get(c, c)}`").alias(c) for c in df.columns]

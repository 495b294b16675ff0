"""Session helpers: a builder for scripts and tests, and the checkpoint folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "textlab", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every operator assumes; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update(conf)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; a cluster session
    without it is an error, because executors do not share a machine-local folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if not current or _plain(configured) not in (_plain(current), _plain(current).rpartition("/")[0]):
            spark.sparkContext.setCheckpointDir(configured)
        return
    if current:
        return
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="textlab-checkpoint-"))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the checkpoint folder, which all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: later steps neither evaluate it again nor need its lineage."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _plain(path: str) -> str:
    """A path without its scheme and closing slash."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:/*", "/", path).rstrip("/")

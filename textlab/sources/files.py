"""File sources and sinks with declared schemas."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlab.schemas import WINE_REQUEST, WINE_TABLE, check_schema

SOURCE_INFO = "path string, exists boolean, n_files long, size_mb double, total_rows long, total_columns long"


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan; with ``schema`` the file's columns are checked against it first."""
    df = spark.read.parquet(path)
    return check_schema(df, schema) if schema else df


def spread(df: DataFrame, *key: str) -> DataFrame:
    """Hash-partition a scan that has fewer splits than the session has cores, so that costly row
    work after it uses all of them; larger scans are returned unchanged."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, *key)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType = WINE_TABLE, rejects: str | None = None
) -> DataFrame:
    """CSV files with headers, each in its own column order; a header must hold the declared columns.

    A value that does not parse is null; ``rejects`` names a column that holds the line of such a row.
    """
    declared = {f.name.lower(): f for f in schema.fields}
    extra = [T.StructField(rejects, T.StringType())] if rejects else []
    parts = []
    for header, paths in _headers(spark, path):
        missing = [f.name for f in schema.fields if f.name.lower() not in {_plain(h).lower() for h in header}]
        if missing:
            raise ValueError(f"columns missing in {paths[0]}: {missing}")
        in_file_order = [declared.get(_plain(h).lower(), T.StructField(h, T.StringType())) for h in header]
        reader = spark.read.schema(T.StructType(in_file_order + extra)).option("header", True).option("enforceSchema", True)
        if rejects:
            reader = reader.option("columnNameOfCorruptRecord", rejects)
        parts.append(reader.csv(paths).select(*[f.name for f in schema.fields + extra]))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], T.StructType(schema.fields + extra))


def _headers(spark: SparkSession, path: str) -> list[tuple[list[str], list[str]]]:
    """(column names, files) for every different first line of the files below ``path``."""
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value",
        F.monotonically_increasing_id().alias("at"),
    ).where("start = 0")
    firsts = lines.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    found = firsts.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect()
    return [(next(csv.reader([row["header"]])), row["files"]) for row in found]


def _plain(name: str) -> str:
    """``fixed acidity`` in a header stands for ``fixed_acidity``."""
    return name.strip().replace(" ", "_")


def read_requests(spark: SparkSession, path: str) -> DataFrame:
    """Scoring requests ``{"wines": [...]}``: one row per record, with the path of its file and its place in it.

    A file that is no JSON or has no records gives one row without a record, whose ``problem`` says so;
    range validation rejects it.
    """
    schema = T.StructType([*WINE_REQUEST.fields, T.StructField("_corrupt", T.StringType())])
    requests = spark.read.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", "_corrupt").json(path)
    problem = F.when(F.col("_corrupt").isNotNull(), F.lit("malformed file")).when(
        F.coalesce(F.size("wines"), F.lit(0)) <= 0, F.lit("no records")
    )
    return requests.select(
        F.col("_metadata.file_path").alias("batch_id"), problem.alias("problem"),
        F.posexplode_outer("wines").alias("position", "wine"),
    ).select("batch_id", F.col("position").cast("long").alias("position"), "wine.*", "problem")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_parquet(df: DataFrame, path: str, compression: str = "snappy") -> None:
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    try:
        spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise
    return True


def source_info(spark: SparkSession, path: str) -> DataFrame:
    """One row: whether the path exists, files, size in MB (2 places), rows and columns.

    Nothing but file metadata is read.
    """
    if not exists(spark, path):
        return spark.createDataFrame([(path, False, 0, 0.0, 0, 0)], SOURCE_INFO)
    df = spark.read.parquet(path)
    # Files without rows have no row that could name them: they are listed, not taken from the rows.
    files = spark.read.format("binaryFile").load(path).agg(
        F.count(F.lit(1)).alias("n_files"), F.round(F.coalesce(F.sum("length"), F.lit(0)) / F.lit(1024 * 1024), 2).alias("size_mb"),
    )
    return files.crossJoin(df.agg(F.count(F.lit(1)).alias("total_rows"))).select(
        F.lit(path).alias("path"), F.lit(True).alias("exists"), "n_files", "size_mb", "total_rows",
        F.lit(len(df.columns)).cast("long").alias("total_columns"),
    )

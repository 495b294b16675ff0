"""A keyed table of embedded chunks, stored as a catalog table of Parquet files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlab.operators.profile import table_counts
from textlab.operators.sizing import small_side
from textlab.session import staged

BUCKETS = 64  # a change writes at least one of these parts of a table


def latest_wins(updates: DataFrame, key: str, seq: Sequence[Column | str]) -> DataFrame:
    """One row per key: the one that comes last by ``seq``. Repeats are cut before the shuffle."""
    last = Window.partitionBy(key).orderBy(*[F.desc(s) if isinstance(s, str) else s.desc() for s in seq])
    return updates.withColumn("_nth", F.row_number().over(last)).filter("_nth = 1").drop("_nth")


def upserted(
    table: DataFrame, updates: DataFrame, key: str, seq: Sequence[Column | str], cluster_by: Sequence[str] = ()
) -> DataFrame:
    """The table after an upsert. Existing rows are only filtered by the updated keys, never sorted;
    with few updates they are not shuffled either. ``cluster_by`` gathers the new rows by the
    partition columns of the files they go to; large partitions stay spread over several tasks."""
    fresh = latest_wins(updates, key, seq).select(*table.columns)
    if cluster_by:
        fresh = fresh.hint("rebalance", *cluster_by)
    kept = table.join(small_side(updates.select(key).distinct()), key, "left_anti")
    return kept.select(*table.columns).unionByName(fresh)


def without(table: DataFrame, condition: Column) -> DataFrame:
    """The rows a delete leaves: where the condition is false or unknown."""
    return table.filter(~F.coalesce(condition, F.lit(False)))


def vector_stats(table: DataFrame, vector: str = "embedding") -> DataFrame:
    """One row: number of vectors, smallest and largest dimension, metric."""
    return table.agg(
        F.count(F.lit(1)).alias("n_vectors"),
        F.min(F.size(vector)).cast("long").alias("min_dim"),
        F.max(F.size(vector)).cast("long").alias("max_dim"),
    ).withColumn("metric", F.lit("cosine"))


def first_rows(table: DataFrame, key: str, n: int, where: Column | None = None) -> DataFrame:
    """The first ``n`` rows by key, optionally of a filtered table."""
    rows = table if where is None else table.filter(where)
    return rows.orderBy(key).limit(n)


class VectorTable:
    """Create, upsert, delete from and drop one table of ``database``.

    Rows lie in partitions by the hash of their key (``_bucket``) and then by ``partition_by``. A change writes only the
    partitions of the buckets it touches, by dynamic partition overwrite, and leaves all other files as they are. Each
    partition is replaced when the write commits; a reader during a commit may see some of them before and some after.
    """

    def __init__(
        self, spark: SparkSession, name: str, database: str = "textlab_vectors",
        key: str = "chunk_id", vector: str = "embedding", partition_by: Sequence[str] = (), buckets: int = BUCKETS,
    ):
        self.spark, self.database, self.key, self.vector = spark, database, key, vector
        self.name, self.partition_by, self._buckets = f"{database}.{name}", list(partition_by), buckets
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name).drop("_bucket")

    def dimension(self) -> int | None:
        """The dimension of the stored vectors; None when nothing is stored."""
        sized = F.col(self.vector).isNotNull()
        row = self.read().where(sized).select(F.size(self.vector)).first() if self.exists() else None
        return row[0] if row else None

    def buckets(self) -> int:
        """The number of buckets the table was made with."""
        return int(self.spark.catalog.getTable(self.name).description) if self.exists() else self._buckets

    def ensure(self, schema: T.StructType, dim: int | None, recreate: bool = False) -> bool:
        """Keep a table whose vectors have ``dim`` entries; create a missing one. True if new.

        A table of another dimension is an error; only ``recreate`` drops it with all its rows.
        """
        if self.exists():
            stored = self.dimension()
            if stored is None or dim in (None, stored):
                return False
            if not recreate:
                raise ValueError(f"{self.name} holds vectors of dimension {stored}, not {dim}")
        self.drop()
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        parts = ", ".join(f"`{c}`" for c in ("_bucket", *self.partition_by))
        self.spark.sql(f"CREATE TABLE {self.name} ({columns}, _bucket int) USING parquet PARTITIONED BY ({parts}) COMMENT '{self._buckets}'")
        return True

    def upsert(self, updates: DataFrame, seq: str) -> None:
        """Insert new keys and overwrite existing ones; of repeated keys the highest ``seq`` wins.

        All vectors must have one dimension, that of the table; null vectors are stored as they are. ``seq`` orders the
        batch and is not stored. The batch is evaluated once.
        """
        fresh = staged(latest_wins(updates, self.key, [seq]).drop(seq), "updates")
        sizes = F.when(F.col(self.vector).isNotNull(), F.size(self.vector))
        low, high = fresh.agg(F.min(sizes), F.max(sizes)).first()
        if low != high:
            raise ValueError(f"vectors of different dimensions: {low} and {high}")
        self.ensure(fresh.schema, low)
        fresh = fresh.withColumn("_bucket", self._bucket())
        touched = self._touched(fresh)
        kept = self._stored(touched).join(small_side(fresh.select(self.key)), self.key, "left_anti")
        self._overwrite(kept.unionByName(fresh), touched)

    def delete(self, condition: Column) -> None:
        """Delete the rows for which the condition is true; only their buckets are written again."""
        touched = self._touched(self.spark.table(self.name).where(condition))
        self._overwrite(without(self._stored(touched), condition), touched)

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets())).cast("int")

    def _touched(self, rows: DataFrame) -> list[int]:
        return [r[0] for r in rows.select("_bucket").distinct().collect()]  # at most as many as buckets

    def _stored(self, touched: list[int]) -> DataFrame:
        return self.spark.table(self.name).where(F.col("_bucket").isin(touched))

    def _overwrite(self, content: DataFrame, touched: list[int]) -> None:
        """Replace all rows of the touched buckets. A partition that loses its last row is not written, so it is dropped."""
        if not touched:
            return
        parts = ["_bucket", *self.partition_by]
        before = set(map(tuple, self._stored(touched).select(*parts).distinct().collect()))
        after = set(map(tuple, content.select(*parts).distinct().collect()))
        columns = self.spark.table(self.name).columns
        place = next(r["data_type"] for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").collect() if r["col_name"] == "Location")
        writer = content.select(*columns).hint("rebalance", *parts).write.mode("overwrite").partitionBy(*parts)
        writer.option("partitionOverwriteMode", "dynamic").parquet(place)
        for gone in before - after:
            spec = ", ".join(f"`{c}` = {_literal(x)}" for c, x in zip(parts, gone))
            self.spark.sql(f"ALTER TABLE {self.name} DROP IF EXISTS PARTITION ({spec})")
        self.spark.catalog.recoverPartitions(self.name)
        self.spark.catalog.refreshTable(self.name)


def _literal(value) -> str:
    if value is None:
        return "null"
    return str(value) if isinstance(value, (int, float)) else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _names(spark: SparkSession, database: str) -> list[str]:
    return [t.name for t in spark.catalog.listTables(database) if t.namespace == [database] and t.tableType != "TEMPORARY"]


def list_tables(spark: SparkSession, database: str = "textlab_vectors") -> DataFrame:
    """(table_name, n) of every vector table in our own database."""
    names = _names(spark, database)
    if not names:
        return spark.createDataFrame([], "table_name string, n long")
    return table_counts({name: spark.table(f"{database}.{name}") for name in names})


def drop_all(spark: SparkSession, database: str = "textlab_vectors") -> None:
    for name in _names(spark, database):
        VectorTable(spark, name, database).drop()

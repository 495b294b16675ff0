"""Text embeddings: a built-in hashing embedder and a batch interface for neural models."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.functions import text as tx
from textlab.functions import vector as vx
from textlab.session import staged
from textlab.sources.files import exists

STORED = "_hash binary, embedding array<float>"
# A loader runs once per Python worker and returns a function from texts to one vector per text.
EmbedderLoader = Callable[[], Callable[[Sequence[str]], Sequence[Sequence[float]]]]


def embed(
    df: DataFrame,
    text: str = "text",
    dim: int = 64,
    loader: EmbedderLoader | None = None,
    batch_size: int = 16,
    partitions: int | None = None,
) -> DataFrame:
    """Add a unit-length ``embedding`` and its ``embedding_dim``.

    Without ``loader`` words are hashed into ``dim`` buckets by built-in expressions. With it,
    texts go to the model in batches of ``batch_size``; ``partitions`` spreads that work first.
    """
    rows = df.repartition(partitions) if partitions else df
    if loader is None:
        return _embed_by_hash(rows, text, dim).withColumn("embedding_dim", F.size("embedding"))

    @F.pandas_udf("array<float>")
    def run_model(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import numpy as np

        model = loader()
        for texts in batches:
            values = texts.fillna("").tolist()
            vectors: list[np.ndarray] = []
            for start in range(0, len(values), batch_size):
                block = np.asarray(model(values[start:start + batch_size]), dtype=np.float64)
                lengths = np.linalg.norm(block, axis=1, keepdims=True)
                vectors.extend((block / np.where(lengths == 0, 1.0, lengths)).astype(np.float32))
            yield pd.Series(vectors, index=texts.index, dtype=object)

    return rows.withColumn("embedding", run_model(text)).withColumn("embedding_dim", F.size("embedding"))


def embed_stored(
    df: DataFrame, store: str, loader: EmbedderLoader, text: str = "text", batch_size: int = 16, partitions: int | None = None,
) -> DataFrame:
    """``embed`` with a model, whose vectors are kept below ``store`` by the SHA-256 of the text: only new texts go to the model.

    Equal texts are embedded once. New ones are range-partitioned and sorted by length, so that the texts of a batch need about
    the same work. Vectors are added when all of them are made; a failed run adds none. Null is embedded like the empty text.
    One store belongs to one model.
    """
    spark, rows = df.sparkSession, df.withColumn("_hash", F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)))
    known = spark.read.schema(STORED).parquet(store) if exists(spark, store) else spark.createDataFrame([], STORED)
    texts = rows.groupBy("_hash").agg(F.first(F.coalesce(F.col(text), F.lit(""))).alias("text"))
    new = staged(texts.join(known.select("_hash"), "_hash", "left_anti"), "new-texts")
    if not new.isEmpty():
        size = F.length("text")
        parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
        sorted_ = new.repartitionByRange(parts, size, "_hash").sortWithinPartitions(size)
        embed(sorted_, "text", loader=loader, batch_size=batch_size).select("_hash", "embedding").write.mode("append").parquet(store)
    stored = spark.read.schema(STORED).parquet(store).dropDuplicates(["_hash"])
    return rows.drop("embedding", "embedding_dim").join(stored, "_hash", "left").drop("_hash").withColumn("embedding_dim", F.size("embedding"))


def _embed_by_hash(df: DataFrame, text: str, dim: int) -> DataFrame:
    """Word counts per bucket, normalised; a text without words keeps the zero vector."""
    from pyspark.ml.feature import CountVectorizerModel, Normalizer
    from pyspark.ml.functions import vector_to_array

    counter = CountVectorizerModel.from_vocabulary(
        [str(i) for i in range(dim)], inputCol="_buckets", outputCol="_counts"
    )
    unit = Normalizer(inputCol="_counts", outputCol="_unit", p=2.0)
    bucketed = df.withColumn("_buckets", vx.hash_buckets(F.coalesce(F.col(text), F.lit("")), dim))
    return (
        unit.transform(counter.transform(bucketed))
        .withColumn("embedding", vector_to_array("_unit", "float32"))
        .drop("_buckets", "_counts", "_unit")
    )


def embed_query(spark, text: str, **options) -> list[float]:
    """The vector of one query text, made by the same embedder as the table."""
    row = embed(spark.createDataFrame([(text,)], "text string"), "text", **options).select("embedding").first()
    return list(row[0])


def normalize_vectors(df: DataFrame, vector: str = "embedding") -> DataFrame:
    return df.withColumn(vector, vx.l2_normalize(vector))


def truncation_check(df: DataFrame, text: str = "text", limit: int = 384, unicode: bool = True) -> DataFrame:
    """One row: texts whose estimated tokens exceed the model's limit, and all texts."""
    return df.agg(
        F.count_if(tx.estimated_tokens(text, unicode) > limit).alias("n_over_limit"),
        F.count(F.lit(1)).alias("n_total"),
    )

"""Retrieval: enrich, chunk, embed, store, search."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from textlab.operators.chunking import chunks
from textlab.operators.embedding import embed, embed_query
from textlab.operators.enrich import enrich
from textlab.operators.search import require_rows, search
from textlab.sources.vector_table import VectorTable


def embedded_chunks(
    sentences: DataFrame, sections: DataFrame, min_tokens: int = 3, sample_size: int | None = None,
    chunking: Mapping | None = None, embedding: Mapping | None = None,
) -> DataFrame:
    """From sentences to embedded chunks as one plan."""
    enriched = enrich(sentences, sections, min_tokens, sample_size)
    return embed(chunks(enriched, sections, **(chunking or {})), **(embedding or {}))


def retrieve(sentences: DataFrame, sections: DataFrame, query: str, k: int = 5, **options) -> DataFrame:
    """The ``k`` chunks closest to a query text."""
    table = embedded_chunks(sentences, sections, **options)
    return search(table, embed_query(sentences.sparkSession, query, **(options.get("embedding") or {})), k)


def _stage(df: DataFrame, path: str, name: str) -> tuple[DataFrame, int]:
    """Write one stage, counting its rows on the way, and read it back."""
    seen = Observation(name)
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path), seen.get["rows"]


def run(
    spark: SparkSession,
    sentences: DataFrame,
    sections: DataFrame,
    target: str,
    table: VectorTable,
    query: str,
    k: int = 5,
    min_tokens: int = 3,
    sample_size: int | None = None,
    chunking: Mapping | None = None,
    embedding: Mapping | None = None,
) -> DataFrame:
    """Every stage is written below ``target`` and can be run again from the one before; the result
    is a (key, value) table of step metrics. Fails when the closing search finds nothing."""
    enriched, rows = _stage(enrich(sentences, sections, min_tokens, sample_size), f"{target}/filtered", "extract")
    chunked, n_chunks = _stage(chunks(enriched, sections, **(chunking or {})), f"{target}/chunks", "chunk")
    embedded, n_embedded = _stage(embed(chunked, **(embedding or {})), f"{target}/embedded", "embed")
    table.upsert(embedded.withColumn("_seq", F.lit(0)), "_seq")
    stored = table.read()
    hits = require_rows(search(stored, embed_query(spark, query, **(embedding or {})), k))
    metrics = [
        ("row_count", rows), ("column_count", len(enriched.columns)), ("chunk_count", n_chunks),
        ("embeddings_created", n_embedded), ("vectors_stored", stored.count()), ("validation_results", hits),
    ]
    return spark.createDataFrame(metrics, "key string, value long")


def step_counts(steps: Mapping[str, DataFrame], known: Mapping[str, int] | None = None) -> DataFrame:
    """(key, value) rows counted from the given steps, without writing anything; ``known`` values
    are added as they are."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("value")).select(F.lit(key).alias("key"), "value") for key, df in steps.items()
    ]
    result = counted[0]
    for other in counted[1:]:
        result = result.unionByName(other)
    if known:
        pairs = F.array(*[
            F.struct(F.lit(key).alias("key"), F.lit(n).cast("long").alias("value")) for key, n in known.items()
        ])
        result = result.unionByName(counted[0].select(F.inline(pairs)))
    return result

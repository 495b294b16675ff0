"""Documents to token ids: toxic documents go, one of each near-duplicate group stays, benchmark leaks go, personal data is masked, pieces are encoded."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.llm import decontamination, jaccard_join, pii, toxicity, unigram
from textlab.llm.staging import set_aside, staged

TOXIC_SCORE = 0.5
SHINGLE_WORDS, SIMILARITY_PERCENT = 5, 80
PIECES = "piece_bpe_32k.model"


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5 in a model of the labels outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(toxicity.fold(F.col("doc_id")) != 0)
    aside, columns = set_aside(docs, ["score"])
    return toxicity.score_toxicity(aside, toxicity.train(docs, labels)).where(F.col("score") < TOXIC_SCORE).select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_first(docs, SHINGLE_WORDS, SIMILARITY_PERCENT)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), "drop")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    masked = pii.redact(docs, pii.train(docs))
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with ``ids`` and ``n_pieces``; the text is what the ids decode to."""
    model = unigram.load(public_tokenizers.path(PIECES))
    coded = unigram.encode(docs, model, decoded="decoded")
    kept = [c for c in docs.columns if c not in ("ids", "decoded", "n_pieces")]
    return coded.withColumn("text", F.when(F.col("text").isNotNull(), F.col("decoded"))).select(*kept, "ids", F.size("ids").alias("n_pieces"))


STAGES = [
    ("toxicity", toxic),
    ("near_duplicates", near_duplicates),
    ("decontamination", benchmark_leaks),
    ("personal_data", personal_data),
    ("pieces", pieces),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

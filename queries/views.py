"""The tables every registered query starts from: Spark views and the same views as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.schemas import SECTIONS, section_dimension
from textlab.sources.files import spread

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut at every ". ", eight pieces per section."""
    parts = F.split("text", r"\. ", -1)
    report = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("doc_id") % 365).cast("int"))
    documents = spread(table(spark, sf_dir, "documents").drop("n_chars"), "doc_id")
    cut = documents.select(
        F.col("doc_id").alias("docID"), F.col("source").alias("name"), F.col("lang").alias("cik"),
        report.alias("reportDate"), F.posexplode(parts).alias("pos", "sentence"),
    )
    return cut.select(
        "docID",
        F.col("pos").cast("long").alias("sentenceID"),
        F.floor(F.col("pos") / 8).cast("int").alias("section"),
        "sentence", "name", "cik", "reportDate",
        F.date_add("reportDate", 30).alias("filingDate"),
        F.length("sentence").cast("long").alias("sentenceCount"),
    )


SENTENCES = """
sentences AS (
  SELECT doc_id AS "docID", CAST(i AS BIGINT) AS "sentenceID", CAST(i // 8 AS INTEGER) AS section,
         parts[i + 1] AS sentence, source AS name, lang AS cik,
         DATE '2020-01-01' + CAST(doc_id % 365 AS INTEGER) AS "reportDate",
         DATE '2020-01-01' + CAST(doc_id % 365 + 30 AS INTEGER) AS "filingDate",
         length(parts[i + 1]) AS "sentenceCount"
  FROM (SELECT *, string_split(text, '. ') AS parts FROM documents) d, unnest(range(len(parts))) AS u(i)
)"""


def number_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as sentences of three numbers; no document text looks like a table."""
    day = F.lit("2020-01-01").cast("date")
    return table(spark, sf_dir, "lineitem").select(
        (-F.col("l_orderkey") - 1).alias("docID"),
        F.col("l_linenumber").cast("long").alias("sentenceID"),
        F.col("l_linenumber").cast("int").alias("section"),
        F.concat_ws(" ", "l_orderkey", "l_partkey", "l_suppkey").alias("sentence"),
        F.col("l_returnflag").alias("name"), F.col("l_linestatus").alias("cik"),
        day.alias("reportDate"), F.date_add(day, 30).alias("filingDate"), F.lit(0).cast("long").alias("sentenceCount"),
    )


NUMBER_ROWS = """
number_rows AS (
  SELECT -l_orderkey - 1 AS "docID", CAST(l_linenumber AS BIGINT) AS "sentenceID",
         CAST(l_linenumber AS INTEGER) AS section,
         concat_ws(' ', l_orderkey, l_partkey, l_suppkey) AS sentence, l_returnflag AS name, l_linestatus AS cik,
         DATE '2020-01-01' AS "reportDate", DATE '2020-01-31' AS "filingDate", CAST(0 AS BIGINT) AS "sentenceCount"
  FROM lineitem
)"""


def mixed_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentences(spark, sf_dir).unionByName(number_rows(spark, sf_dir))


MIXED = f"""{SENTENCES}, {NUMBER_ROWS},
mixed AS (SELECT * FROM sentences UNION ALL BY NAME SELECT * FROM number_rows)"""

SECTION_ROWS = "sections(section, name, priority) AS (VALUES " + ", ".join(
    f"({code}, '{name}', '{priority}')" for code, name, priority, _ in SECTIONS
) + ")"


def sections(spark: SparkSession) -> DataFrame:
    return section_dimension(spark)


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings with a payload: the label is the section."""
    rows = table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("chunk_id"),
        "vec_id",
        F.col("label").alias("section"),
        F.concat(F.lit("C"), F.substring(F.md5(F.col("vec_id").cast("string").cast("binary")), 1, 1)).alias("company"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("vec_id") % 365).cast("int")).alias("reportDate"),
        F.concat(F.lit("vector "), F.col("vec_id").cast("string"), F.lit(" of label "),
                 F.col("label").cast("string")).alias("text"),
        "embedding",
    )
    return with_section_columns(rows, sections(spark))


def with_section_columns(df: DataFrame, dimension: DataFrame) -> DataFrame:
    from textlab.operators.enrich import with_priority, with_section_name

    return with_section_name(with_priority(df, dimension, "priority"), dimension)


VECTORS = f"""{SECTION_ROWS},
vectors AS (
  SELECT 'v' || vec_id AS chunk_id, vec_id, label AS section,
         'C' || substr(md5(CAST(vec_id AS VARCHAR)), 1, 1) AS company,
         DATE '2020-01-01' + CAST(vec_id % 365 AS INTEGER) AS "reportDate",
         'vector ' || vec_id || ' of label ' || label AS text, CAST(embedding AS DOUBLE[]) AS embedding,
         coalesce(s.priority, 'unknown') AS priority, coalesce(s.name, 'Section_' || label) AS section_name
  FROM embeddings LEFT JOIN sections s ON s.section = label
)"""


def query_vector(spark: SparkSession, sf_dir: str) -> list[float]:
    """The vector with the smallest id."""
    return list(table(spark, sf_dir, "embeddings").orderBy("vec_id").select("embedding").first()[0])


QUERY_VECTOR = "q AS (SELECT CAST(arg_min(embedding, vec_id) AS DOUBLE[]) AS qv FROM embeddings)"


def document_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with text features and a fixed rule as a stand-in prediction."""
    from textlab.operators.enrich import text_features

    joined = table(spark, sf_dir, "documents").select("doc_id", "text").join(
        table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id"
    )
    return text_features(joined, "text").drop("text").withColumn(
        "prediction", F.when(F.col("char_count") > 1500, 1).otherwise(0)
    )


DOCUMENT_FEATURES = """
document_features AS (
  SELECT doc_id, quality, length(text) AS char_count, len(string_split(text, ' ')) AS word_count,
         length(text) / len(string_split(text, ' ')) AS avg_word_length,
         CASE WHEN length(text) > 1500 THEN 1 ELSE 0 END AS prediction
  FROM documents JOIN labels USING (doc_id)
)"""

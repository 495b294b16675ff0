"""Profile, comparison and text-feature queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries import views as v
from queries.family import Family
from textlab.functions import text as tx
from textlab.operators import enrich as en
from textlab.operators import profile
from textlab.plans import comparisons, overview
from textlab.sources.files import source_info

family = Family()
query = family.query


@query("shape", f"""WITH {v.SENTENCES}
SELECT count(*) AS total_rows, CAST(9 AS BIGINT) AS total_columns,
  'docID,sentenceID,section,sentence,name,cik,reportDate,filingDate,sentenceCount' AS column_names FROM sentences""")
def shape(spark, sf):
    return profile.shape(v.sentences(spark, sf))


def _unique(column: str) -> str:
    return (f"SELECT '{column}' AS column_name, CAST(count(DISTINCT \"{column}\") + "
            f"coalesce(max(CAST(\"{column}\" IS NULL AS INTEGER)), 0) AS BIGINT) AS unique_count FROM sentences")


@query("unique_counts", f"WITH {v.SENTENCES} " + " UNION ALL ".join(
    _unique(c) for c in ("name", "cik", "section", "docID")))
def unique_counts(spark, sf):
    return profile.unique_counts(v.sentences(spark, sf), ["name", "cik", "section", "docID"])


@query("unique_exploded", """SELECT 'words' AS column_name, count(DISTINCT w) AS unique_count
FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents)""")
def unique_exploded(spark, sf):
    words = v.table(spark, sf, "documents").select(F.split("text", " ", -1).alias("words"))
    return profile.unique_exploded(words, "words")


@query("missing_data", f"""WITH {v.SENTENCES}, wide AS (
  SELECT s."docID", s.sentence, l.quality, l.toxic FROM sentences s LEFT JOIN labels l ON l.doc_id = s."docID")
SELECT * FROM (
  SELECT 'docID' AS column_name, count(*) - count("docID") AS n_missing FROM wide
  UNION ALL SELECT 'sentence', count(*) - count(sentence) FROM wide
  UNION ALL SELECT 'quality', count(*) - count(quality) FROM wide
  UNION ALL SELECT 'toxic', count(*) - count(toxic) FROM wide) WHERE n_missing > 0""")
def missing_data(spark, sf):
    wide = v.sentences(spark, sf).join(
        v.table(spark, sf, "labels"), F.col("docID") == F.col("doc_id"), "left"
    ).select("docID", "sentence", "quality", "toxic")
    return profile.missing_data(wide)


@query("group_count", f"WITH {v.SENTENCES} SELECT name, count(*) AS n FROM sentences GROUP BY name")
def group_count(spark, sf):
    return profile.group_count(v.sentences(spark, sf), "name")


@query("top_companies", f"""WITH {v.SENTENCES} SELECT name, count(*) AS sentence_count FROM sentences
GROUP BY name ORDER BY sentence_count DESC, name NULLS FIRST LIMIT 10""")
def top_companies(spark, sf):
    return profile.top_groups(v.sentences(spark, sf), "name", 10, "sentence_count")


@query("section_distribution", f"""WITH {v.SENTENCES} SELECT section, count(*) AS n FROM sentences
GROUP BY section ORDER BY n DESC, section NULLS FIRST LIMIT 15""")
def section_distribution(spark, sf):
    return profile.top_groups(v.sentences(spark, sf), "section", 15)


@query("distinct_first", f"""WITH {v.SENTENCES} SELECT DISTINCT section FROM sentences
ORDER BY section NULLS FIRST LIMIT 10""")
def distinct_first(spark, sf):
    return profile.first_distinct(v.sentences(spark, sf), "section", 10)


@query("date_range", """SELECT CAST(CAST(min(o_orderdate) AS DATE) AS VARCHAR) AS earliest,
  CAST(CAST(max(o_orderdate) AS DATE) AS VARCHAR) AS latest FROM orders""")
def date_range(spark, sf):
    orders = v.table(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return profile.date_range(orders, "day")


@query("text_stats", f"""WITH {v.SENTENCES} SELECT avg(length(sentence)) AS avg_length,
  CAST(median(length(sentence)) AS DOUBLE) AS median_length, CAST(min(length(sentence)) AS BIGINT) AS min_length,
  CAST(max(length(sentence)) AS BIGINT) AS max_length FROM sentences""")
def text_stats(spark, sf):
    return profile.text_stats(v.sentences(spark, sf), "sentence")


@query("avg_length", f"WITH {v.SENTENCES} SELECT avg(length(sentence)) AS avg_length FROM sentences")
def avg_length(spark, sf):
    return profile.avg_length(v.sentences(spark, sf), "sentence")


@query("filter_contains", """SELECT p_partkey, p_name, p_type FROM part WHERE contains(p_name, 'ring')""")
def filter_contains(spark, sf):
    part = v.table(spark, sf, "part").select("p_partkey", "p_name", "p_type")
    return comparisons.filter_contains(part, "p_name", "ring")


@query("filter_contains_text", """SELECT doc_id, text, source FROM documents WHERE contains(text, 'the')""")
def filter_contains_text(spark, sf):
    documents = v.table(spark, sf, "documents").select("doc_id", "text", "source")
    return comparisons.filter_contains(documents, "text", "the")


@query("sort_date", """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date FROM orders
ORDER BY o_orderdate NULLS FIRST, o_orderkey""")
def sort_date(spark, sf):
    orders = v.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return comparisons.sort_ascending(orders, "o_orderdate", "o_orderkey").select(
        "o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("order_date")
    )


@query("chain_top10", f"""WITH {v.SENTENCES} SELECT name, count(*) AS n FROM sentences WHERE section = 1
GROUP BY name ORDER BY n DESC, name NULLS FIRST LIMIT 10""")
def chain_top10(spark, sf):
    return comparisons.chain_top(v.sentences(spark, sf), 1)


@query("text_features", f"""WITH {v.SENTENCES} SELECT "docID", "sentenceID", length(sentence) AS char_count,
  len(string_split(sentence, ' ')) AS word_count,
  length(sentence) / len(string_split(sentence, ' ')) AS avg_word_length FROM sentences""")
def text_features(spark, sf):
    return en.text_features(v.sentences(spark, sf)).select(
        "docID", "sentenceID", F.col("char_count").cast("long").alias("char_count"),
        F.col("word_count").cast("long").alias("word_count"), "avg_word_length",
    )


@query("clean_features", """SELECT event_id,
  CASE WHEN value IS NULL OR isnan(r) OR isinf(r) THEN 0.0 ELSE r END AS cleaned
FROM (SELECT event_id, value, CASE event_type WHEN 'error' THEN CAST('nan' AS DOUBLE)
  WHEN 'view' THEN CAST('inf' AS DOUBLE) WHEN 'signup' THEN CAST('-inf' AS DOUBLE) ELSE value END AS r FROM events)""")
def clean_features(spark, sf):
    from textlab.functions.numeric import finite_or_zero

    raw = (
        F.when(F.col("event_type") == "error", F.lit(float("nan")))
        .when(F.col("event_type") == "view", F.lit(float("inf")))
        .when(F.col("event_type") == "signup", F.lit(float("-inf")))
        .otherwise(F.col("value"))
    )
    return v.table(spark, sf, "events").select("event_id", finite_or_zero(raw).alias("cleaned"))


@query("preview", """SELECT doc_id,
  CASE WHEN length(text) > 200 THEN substr(text, 1, 200) || '...' ELSE text END AS short_text,
  substr(text, 1, 300) || '...' AS cut_text FROM documents""")
def preview(spark, sf):
    return v.table(spark, sf, "documents").select(
        "doc_id", tx.preview("text", 200).alias("short_text"), tx.preview("text", 300, always=True).alias("cut_text")
    )


@query("table_counts", " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in v.TABLES))
def table_counts(spark, sf):
    return profile.table_counts({t: v.table(spark, sf, t) for t in v.TABLES})


@query("source_info", """SELECT true AS "exists", CAST(1 AS BIGINT) AS n_files, count(*) AS total_rows,
  CAST(5 AS BIGINT) AS total_columns FROM documents""")
def documents_source(spark, sf):
    info = source_info(spark, f"{sf}/documents.parquet")
    return info.select("exists", "n_files", "total_rows", "total_columns")


_EMPTY = "CAST(NULL AS DOUBLE)"


@query("overall_stats", f"""WITH {v.SENTENCES},
counted AS (SELECT name, count(*) AS n FROM sentences GROUP BY name ORDER BY n DESC, name NULLS FIRST LIMIT 10),
by_section AS (
  SELECT section, count(*) AS n FROM sentences GROUP BY section ORDER BY n DESC, section NULLS FIRST LIMIT 15)
SELECT 'shape' AS part, 'rows' AS item, CAST(count(*) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM sentences
UNION ALL SELECT 'shape', 'columns', 9.0,
  'docID,sentenceID,section,sentence,name,cik,reportDate,filingDate,sentenceCount'
UNION ALL SELECT 'dates', 'earliest', {_EMPTY}, CAST(min("filingDate") AS VARCHAR) FROM sentences
UNION ALL SELECT 'dates', 'latest', {_EMPTY}, CAST(max("filingDate") AS VARCHAR) FROM sentences
UNION ALL SELECT 'unique', 'name', count(DISTINCT name), NULL FROM sentences
UNION ALL SELECT 'unique', 'cik', count(DISTINCT cik), NULL FROM sentences
UNION ALL SELECT 'unique', 'section', count(DISTINCT section), NULL FROM sentences
UNION ALL SELECT 'length', 'avg_length', avg(length(sentence)), NULL FROM sentences
UNION ALL SELECT 'length', 'median_length', median(length(sentence)), NULL FROM sentences
UNION ALL SELECT 'length', 'min_length', min(length(sentence)), NULL FROM sentences
UNION ALL SELECT 'length', 'max_length', max(length(sentence)), NULL FROM sentences
UNION ALL SELECT 'top_groups', name, n, NULL FROM counted
UNION ALL SELECT 'section_distribution', CAST(section AS VARCHAR), n, NULL FROM by_section""")
def overall_stats(spark, sf):
    df = v.sentences(spark, sf)
    return overview.as_rows(df, overview.overall_stats(df))

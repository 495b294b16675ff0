"""Enrichment, sampling, chunking and embedding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries import views as v
from queries.family import Family
from textlab.operators import chunking, embedding, sampling, search
from textlab.operators.enrich import enrich, with_priority
from textlab.plans.retrieval import step_counts
from textlab.sources.vector_table import latest_wins

family = Family()
query = family.query

ENRICHED = f"""{v.SECTION_ROWS}, {v.MIXED},
enriched AS (
  SELECT m."docID", m."sentenceID", m.section, m.sentence, m.name, m.cik, m."reportDate",
         CAST(len(string_split(sentence, ' ')) AS INTEGER) AS token_count,
         CAST(length(sentence) AS INTEGER) AS char_count,
         coalesce(s.priority, 'unknown') AS section_priority,
         length(sentence) > 1000 AS is_long_text, length(sentence) < 20 AS is_fragment,
         regexp_matches(sentence, '\\d+\\s+\\d+\\s+\\d+') AS likely_table
  FROM mixed m LEFT JOIN sections s USING (section)
  WHERE len(string_split(sentence, ' ')) >= 3
)"""


@query("enrich", f"""WITH {ENRICHED} SELECT * EXCLUDE ("reportDate"), CAST("reportDate" AS VARCHAR) AS report_date
FROM enriched""")
def enriched(spark, sf):
    rows = enrich(v.mixed_sentences(spark, sf), v.sections(spark), unicode=False)
    return rows.withColumn("report_date", F.col("reportDate").cast("string")).drop("reportDate")


@query("sample_n", f"""WITH {v.SENTENCES} SELECT "docID", "sentenceID", sentence FROM sentences
ORDER BY md5(concat_ws('|', '42', "docID", "sentenceID")), "docID", "sentenceID" LIMIT 1000""")
def sample_n(spark, sf):
    rows = v.sentences(spark, sf).select("docID", "sentenceID", "sentence")
    return sampling.sample_n(rows, 1000, ["docID", "sentenceID"])


@query("sample_stratified", f"""WITH {v.SENTENCES}, placed AS (
  SELECT "docID", "sentenceID", section,
         row_number() OVER (PARTITION BY section
           ORDER BY md5(concat_ws('|', '42', "docID", "sentenceID")), "docID", "sentenceID") AS nth,
         count(*) OVER (PARTITION BY section) AS size, count(*) OVER () AS total
  FROM sentences)
SELECT "docID", "sentenceID", section FROM placed
WHERE nth <= least(size, greatest(10, CAST(floor(2000 * size / total) AS BIGINT)))""")
def sample_stratified(spark, sf):
    rows = v.sentences(spark, sf).select("docID", "sentenceID", "section")
    return sampling.stratified(rows, 2000, ["section"], ["docID", "sentenceID"])


SPLIT = """split AS (
  SELECT *, row_number() OVER (PARTITION BY quality ORDER BY md5(concat_ws('|', '42', doc_id)), doc_id)
            <= CAST(round(count(*) OVER (PARTITION BY quality) * 0.2) AS BIGINT) AS is_test
  FROM {table})"""


@query("split_stratified", f"""WITH {SPLIT.format(table="labels")} SELECT doc_id, quality, is_test FROM split""")
def split_stratified(spark, sf):
    labels = v.table(spark, sf, "labels").select("doc_id", "quality")
    return sampling.split_flag(labels, ["quality"], ["doc_id"])


def chunk_sql(max_chars: int, where: str = "true", tail: bool = True) -> str:
    left = "OR (pos % 2 = 0 AND pos > n - 3 AND pos - 2 <= n - 3 AND pos + 1 < n)" if tail else ""
    return f"""{v.SECTION_ROWS}, {v.SENTENCES},
kept AS (SELECT * FROM sentences WHERE {where}),
placed AS (
  SELECT *, row_number() OVER g - 1 AS pos, count(*) OVER (PARTITION BY "docID", section) AS n,
         sentence AS s1, lead(sentence, 1) OVER g AS s2, lead(sentence, 2) OVER g AS s3,
         first_value(name) OVER g AS first_name, first_value("reportDate") OVER g AS first_date,
         first_value(cik) OVER g AS first_cik
  FROM kept WINDOW g AS (PARTITION BY "docID", section ORDER BY "sentenceID", sentence)),
heads AS (
  SELECT *, concat_ws(' ', s1, s2, s3) AS joined FROM placed
  WHERE (pos % 2 = 0 AND pos <= n - 3) OR (pos = 0 AND n < 3) {left}),
second AS (
  SELECT *, n >= 3 AND length(joined) > {max_chars} AS cut,
         length(s1) + length(s2) < {max_chars} AS fits2 FROM heads),
third AS (
  SELECT *, CASE WHEN NOT fits2 THEN s2 WHEN s1 = '' THEN s2 ELSE s1 || ' ' || s2 END AS cur2,
         CASE WHEN fits2 OR s1 = '' THEN CAST([] AS VARCHAR[]) ELSE [s1] END AS done2 FROM second),
fourth AS (SELECT *, length(cur2) + length(s3) < {max_chars} AS fits3 FROM third),
packed AS (
  SELECT *, CASE WHEN s3 IS NULL THEN cur2 WHEN NOT fits3 THEN s3 WHEN cur2 = '' THEN s3 ELSE cur2 || ' ' || s3 END AS cur3,
         CASE WHEN s3 IS NULL OR fits3 OR cur2 = '' THEN done2 ELSE list_append(done2, cur2) END AS done3 FROM fourth),
parts AS (
  SELECT *, CASE WHEN NOT cut THEN [joined] WHEN cur3 = '' THEN done3 ELSE list_append(done3, cur3) END AS texts
  FROM packed),
chunks AS (
  SELECT "docID" || '_sec' || p.section
           || CASE WHEN n < 3 THEN '_full' ELSE '_chunk' || pos END
           || CASE WHEN cut THEN '_part' || j ELSE '' END AS chunk_id,
         texts[j + 1] AS text, "docID", p.section, coalesce(s.name, 'Section_' || p.section) AS section_name,
         first_name AS company, CAST(first_date AS VARCHAR) AS report_date, first_cik AS cik,
         coalesce(s.priority, 'unknown') AS priority, CAST(least(n - pos, 3) AS INTEGER) AS n_sentences,
         CAST(length(texts[j + 1]) AS INTEGER) AS char_count, CASE WHEN n >= 3 THEN cut END AS is_split
  FROM (SELECT *, unnest(range(len(texts))) AS j FROM parts) p LEFT JOIN sections s ON s.section = p.section)"""


def chunk_rows(spark, sf, max_chars=2000, **options):
    dimension = v.sections(spark)
    return chunking.chunks(with_priority(v.sentences(spark, sf), dimension), dimension, max_chars=max_chars, **options)


def _dated(df):
    return df.withColumn("report_date", F.col("reportDate").cast("string")).drop("reportDate")


@query("chunks", f"WITH {chunk_sql(2000)} SELECT * FROM chunks")
def chunks(spark, sf):
    return _dated(chunk_rows(spark, sf))


@query("chunks_full_windows", f"WITH {chunk_sql(2000, tail=False)} SELECT * FROM chunks")
def chunks_full_windows(spark, sf):
    return _dated(chunk_rows(spark, sf, keep_tail=False))


@query("chunks_split", f"WITH {chunk_sql(400)} SELECT * FROM chunks WHERE is_split")
def chunks_split(spark, sf):
    return _dated(chunk_rows(spark, sf, 400)).filter("is_split")


@query("chunk_stats", f"""WITH {chunk_sql(400)} SELECT count(*) AS n_chunks,
  CAST(min(char_count) AS BIGINT) AS min_chars,
  CAST(max(char_count) AS BIGINT) AS max_chars, avg(char_count) AS avg_chars,
  count(*) FILTER (WHERE is_split) AS n_split FROM chunks""")
def chunk_stats(spark, sf):
    return chunking.chunk_stats(chunk_rows(spark, sf, 400))


@query("truncation_check", f"""WITH {chunk_sql(2000)} SELECT
  count(*) FILTER (WHERE len(regexp_extract_all(text, '\\S+')) > 40) AS n_over_limit, count(*) AS n_total FROM chunks""")
def truncation_check(spark, sf):
    return embedding.truncation_check(chunk_rows(spark, sf), limit=40, unicode=False)


HASHED = """
words AS (
  SELECT {key}, unnest(list_filter(regexp_split_to_array({text}, '\\s+'), lambda w: w <> '')) AS w FROM {table}),
buckets AS (
  SELECT {key}, CAST(CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) % 64 AS INTEGER) AS bucket, count(*) AS n
  FROM words GROUP BY ALL),
hashed AS (
  SELECT {key}, bucket, CAST(n / sqrt(sum(n * n) OVER (PARTITION BY {key})) AS FLOAT) AS weight FROM buckets)"""


@query("embed_hash", f"""WITH {v.SENTENCES},
{HASHED.format(key='"docID", "sentenceID"', text="sentence", table="sentences")}
SELECT "docID", "sentenceID", bucket, round(CAST(weight AS DOUBLE), 6) AS weight FROM hashed""")
def embed_hash(spark, sf):
    vectors = embedding.embed(v.sentences(spark, sf).select("docID", "sentenceID", "sentence"), "sentence", 64)
    return (
        vectors.select("docID", "sentenceID", F.posexplode_outer("embedding").alias("bucket", "weight"))
        .filter("weight <> 0")
        .withColumn("weight", F.round(F.col("weight").cast("double"), 6))
    )


@query("normalize_vectors", """WITH long AS (
  SELECT vec_id, label, i - 1 AS place, CAST(embedding[i] AS DOUBLE) * (label + 1) AS x
  FROM embeddings, unnest(range(1, 65)) AS u(i))
SELECT vec_id, CAST(place AS INTEGER) AS place,
  round(x / sqrt(sum(x * x) OVER (PARTITION BY vec_id)), 6) AS x FROM long""")
def normalize_vectors(spark, sf):
    scaled = v.table(spark, sf, "embeddings").withColumn(
        "embedding", F.transform("embedding", lambda x: x.cast("double") * (F.col("label") + 1))
    )
    unit = embedding.normalize_vectors(scaled)
    return unit.select("vec_id", F.posexplode("embedding").alias("place", "x")).withColumn("x", F.round("x", 6))


@query("step_metrics", f"""WITH {chunk_sql(2000, "len(string_split(sentence, ' ')) >= 3")}
SELECT 'row_count' AS key, count(*) AS value FROM kept
UNION ALL SELECT 'column_count', 13
UNION ALL SELECT 'chunk_count', count(*) FROM chunks
UNION ALL SELECT 'embeddings_created', count(*) FROM chunks
UNION ALL SELECT 'vectors_stored', count(DISTINCT chunk_id) FROM chunks
UNION ALL SELECT 'validation_results', least(count(DISTINCT chunk_id), 5) FROM chunks""")
def step_metrics(spark, sf):
    dimension = v.sections(spark)
    rows = enrich(v.sentences(spark, sf), dimension)
    chunked = chunking.chunks(rows, dimension)
    embedded = embedding.embed(chunked)
    stored = latest_wins(embedded, "chunk_id", ["text"])
    hits = search.search(stored, embedding.embed_query(spark, "main risk factors"), 5)
    return step_counts(
        {"row_count": rows, "chunk_count": chunked, "embeddings_created": embedded, "vectors_stored": stored, "validation_results": hits},
        {"column_count": len(rows.columns)},
    )

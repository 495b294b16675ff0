"""Vector table and search queries over ``embeddings``."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from queries import views as v
from queries.family import Family
from textlab.functions import vector as vx
from textlab.operators import search as se
from textlab.session import shared_path
from textlab.sources import vector_table as vt
from textlab.sources.vector_index import VectorIndex

family = Family()
query = family.query

SCORED = f"""{v.VECTORS}, {v.QUERY_VECTOR},
scored AS (SELECT * EXCLUDE (embedding), list_inner_product(embedding, (SELECT qv FROM q)) AS raw_score FROM vectors)"""
PAYLOAD = """chunk_id, vec_id, section, company, CAST("reportDate" AS VARCHAR) AS report_date, priority,
  round(raw_score, 6) AS score"""


def _payload(df):
    return df.select("chunk_id", "vec_id", "section", "company", F.col("reportDate").cast("string").alias("report_date"),
                     "priority", F.round("score", 6).alias("score"))


@query("vector_stats", f"""SELECT count(*) AS n_vectors, CAST(min(len(embedding)) AS BIGINT) AS min_dim,
  CAST(max(len(embedding)) AS BIGINT) AS max_dim, 'cosine' AS metric FROM embeddings""")
def vector_stats(spark, sf):
    return vt.vector_stats(v.vectors(spark, sf))


@query("list_first", f"""WITH {v.VECTORS} SELECT chunk_id, vec_id, section, company FROM vectors
ORDER BY vec_id LIMIT 5""")
def list_first(spark, sf):
    return vt.first_rows(v.vectors(spark, sf).select("chunk_id", "vec_id", "section", "company"), "vec_id", 5)


@query("list_filtered", f"""WITH {v.VECTORS} SELECT chunk_id, vec_id, section, company FROM vectors WHERE section = 8
ORDER BY vec_id LIMIT 10""")
def list_filtered(spark, sf):
    rows = v.vectors(spark, sf).select("chunk_id", "vec_id", "section", "company")
    return vt.first_rows(rows, "vec_id", 10, F.col("section") == 8)


@query("delete_where", f"""WITH {v.VECTORS} SELECT chunk_id, section, company FROM vectors
WHERE NOT coalesce(company = 'C3' AND section < 5, false)""")
def delete_where(spark, sf):
    rows = v.vectors(spark, sf).select("chunk_id", "section", "company")
    return vt.without(rows, (F.col("company") == "C3") & (F.col("section") < 5))


@query("upsert_latest", f"""WITH {v.VECTORS},
updates AS (
  SELECT * REPLACE ('EARLIER' AS company), 1 AS seq FROM vectors WHERE section = 3
  UNION ALL BY NAME SELECT * REPLACE ('NEW' AS company), 2 AS seq FROM vectors WHERE section = 3
  UNION ALL BY NAME SELECT * REPLACE ('n' || vec_id AS chunk_id), 3 AS seq FROM vectors WHERE section = 4),
fresh AS (SELECT * EXCLUDE (seq) FROM updates
          QUALIFY row_number() OVER (PARTITION BY chunk_id ORDER BY seq DESC) = 1)
SELECT chunk_id, section, company, round(embedding[1], 6) AS first_value FROM (
  SELECT * FROM vectors WHERE chunk_id NOT IN (SELECT chunk_id FROM updates)
  UNION ALL BY NAME SELECT * FROM fresh)""")
def upsert_latest(spark, sf):
    rows = v.vectors(spark, sf)
    renewed = rows.filter("section = 3")
    updates = (
        renewed.withColumns({"company": F.lit("EARLIER"), "seq": F.lit(1)})
        .unionByName(renewed.withColumns({"company": F.lit("NEW"), "seq": F.lit(2)}))
        .unionByName(rows.filter("section = 4").withColumns({
            "chunk_id": F.concat(F.lit("n"), F.col("vec_id").cast("string")), "seq": F.lit(3),
        }))
    )
    return vt.upserted(rows, updates, "chunk_id", ["seq"]).select(
        "chunk_id", "section", "company", F.round(F.col("embedding")[0].cast("double"), 6).alias("first_value")
    )


@query("search_topk", f"WITH {SCORED} SELECT {PAYLOAD} FROM scored ORDER BY raw_score DESC, chunk_id LIMIT 5")
def search_topk(spark, sf):
    return _payload(se.search(v.vectors(spark, sf), v.query_vector(spark, sf), 5))


@query("search_in_sections", f"""WITH {SCORED} SELECT {PAYLOAD} FROM scored WHERE section IN (1, 7, 9)
ORDER BY raw_score DESC, chunk_id LIMIT 5""")
def search_in_sections(spark, sf):
    return _payload(se.search(v.vectors(spark, sf), v.query_vector(spark, sf), 5, se.filters(sections=[1, 7, 9])))


@query("search_filtered", f"""WITH {SCORED} SELECT {PAYLOAD} FROM scored WHERE company = 'C3'
  AND "reportDate" BETWEEN DATE '2020-02-01' AND DATE '2020-10-31' AND priority IN ('high', 'highest')
ORDER BY raw_score DESC, chunk_id LIMIT 10""")
def search_filtered(spark, sf):
    where = se.filters(company="C3", date_range=("2020-02-01", "2020-10-31"), high_priority_only=True)
    return _payload(se.search(v.vectors(spark, sf), v.query_vector(spark, sf), 10, where))


@query("search_batch", f"""WITH {v.VECTORS},
asked AS (SELECT section AS query_id, arg_min(embedding, vec_id) AS qv FROM vectors GROUP BY section),
scored AS (SELECT query_id, chunk_id, list_inner_product(embedding, qv) AS raw_score FROM asked, vectors),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY raw_score DESC, chunk_id) AS rank FROM scored)
SELECT query_id, rank, chunk_id, round(raw_score, 6) AS score FROM ranked WHERE rank <= 5""")
def search_batch(spark, sf):
    rows = v.vectors(spark, sf)
    asked = rows.groupBy(F.col("section").alias("query_id")).agg(F.min_by("embedding", "vec_id").alias("query_vector"))
    return se.search_batch(rows, asked, 5).withColumn("score", F.round("score", 6))


@query("search_batch_many", f"""WITH {v.VECTORS},
asked AS (SELECT vec_id AS query_id, embedding AS qv FROM vectors WHERE vec_id % 20 = 0),
scored AS (SELECT query_id, chunk_id, list_inner_product(embedding, qv) AS raw_score FROM asked, vectors),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY raw_score DESC, chunk_id) AS rank FROM scored)
SELECT query_id, rank, chunk_id, round(raw_score, 6) AS score FROM ranked WHERE rank <= 5""")
def search_batch_many(spark, sf):
    rows = v.vectors(spark, sf)
    asked = rows.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    return se.search_batch(rows, asked, 5).withColumn("score", F.round("score", 6))


@query("search_display", f"""WITH {SCORED}, best AS (
  SELECT *, row_number() OVER (ORDER BY raw_score DESC, chunk_id) AS rank FROM scored
  QUALIFY rank <= 5)
SELECT rank, round(raw_score, 4) AS score, company, section, section_name, CAST("reportDate" AS VARCHAR) AS report_date,
  priority, substr(text, 1, 300) || '...' AS text_preview, chunk_id FROM best""")
def search_display(spark, sf):
    return se.display(se.search(v.vectors(spark, sf), v.query_vector(spark, sf), 5))


@query("search_approximate")
def search_approximate(spark, sf):
    rows = v.vectors(spark, sf)
    found = se.search_approximate(se.approximate_index(rows), rows, v.query_vector(spark, sf), 5)
    return found.select("chunk_id", "section", "company", F.round("score", 6).alias("score"))


@query("search_indexed", f"""WITH {v.VECTORS} SELECT vec_id AS query_id, least(5, (SELECT count(*) FROM vectors)) AS n_hits,
  least(5, (SELECT count(*) FROM vectors)) AS n_exact, true AS recall_reached FROM vectors WHERE vec_id % 20 = 0""")
def search_indexed(spark, sf):
    """Hits of a stored index for every twentieth vector: how many have the exact score, and whether 0.9 of all true hits are found."""
    rows = v.vectors(spark, sf)
    index = VectorIndex.build(rows, shared_path(spark, "index"))
    asked = rows.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    found = index.search_batch(asked, 5).join(rows.select("chunk_id", "embedding"), "chunk_id").join(asked, "query_id")
    true = F.abs(F.col("score") - vx.dot("embedding", F.col("query_vector"))) < 1e-9
    hits = found.select("query_id", "chunk_id", true.alias("exact"))
    wanted = se.search_batch(rows, asked, 5).join(hits, ["query_id", "chunk_id"], "left")
    recall = wanted.agg(F.avg(F.col("exact").isNotNull().cast("double"))).first()[0]
    return hits.groupBy("query_id").agg(
        F.count(F.lit(1)).alias("n_hits"), F.count_if("exact").alias("n_exact"), F.lit((recall or 0) >= 0.9).alias("recall_reached"))


@query("index_rows", f"""WITH {v.VECTORS} SELECT chunk_id, vec_id, company, CAST(1 AS BIGINT) AS n_rows,
  CAST(len(embedding) // 4 AS BIGINT) AS code_bytes FROM vectors WHERE embedding IS NOT NULL""")
def index_rows(spark, sf):
    """Every row is in one list of the stored index, with a code of a byte for four components."""
    index = VectorIndex.build(v.vectors(spark, sf), shared_path(spark, "index"))
    return index.read().groupBy("chunk_id", "vec_id", "company").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(F.octet_length("_code")).cast("long").alias("code_bytes"))


@query("vector_table_changes", f"""WITH {v.VECTORS},
updates AS (SELECT * REPLACE ('NEW' AS company) FROM vectors WHERE section = 3
            UNION ALL BY NAME SELECT * REPLACE ('n' || vec_id AS chunk_id) FROM vectors WHERE section = 4)
SELECT chunk_id, section, company, round(embedding[1], 6) AS first_value FROM (
  SELECT * FROM vectors WHERE chunk_id NOT IN (SELECT chunk_id FROM updates) UNION ALL BY NAME SELECT * FROM updates)
WHERE NOT coalesce(company = 'C3' AND section < 5, false)""")
def vector_table_changes(spark, sf):
    """A stored table after an insert, an upsert and a delete, each of which writes only the buckets it touches."""
    table = vt.VectorTable(spark, f"changes_{uuid.uuid4().hex}", "textlab_queries", partition_by=["section"], buckets=8)
    rows = v.vectors(spark, sf).withColumn("seq", F.lit(0))
    table.upsert(rows, "seq")
    renewed = rows.filter("section = 3").withColumn("company", F.lit("NEW"))
    table.upsert(renewed.unionByName(rows.filter("section = 4").withColumn("chunk_id", F.concat(F.lit("n"), F.col("vec_id").cast("string")))), "seq")
    table.delete((F.col("company") == "C3") & (F.col("section") < 5))
    return table.read().select("chunk_id", "section", "company", F.round(F.col("embedding")[0].cast("double"), 6).alias("first_value"))

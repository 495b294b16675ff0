"""One query per operator, over its whole table, and SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlab.llm import (
    decontamination, embedding_links, jaccard_join, packing, periodic_runs, pii, suffix_dedup, token_files, toxicity, unigram, url_filters, vector_codes, warc,
)

RULES = [  # fixed values of the contract
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"),
]
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLES["op1_decontamination"] = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
grams AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
          FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS u(i) WHERE len(w) > 0),
places AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
           FROM words, (SELECT DISTINCT n FROM grams) s, unnest(range(1, len(w) - n + 2)) AS u(i)),
hits AS (SELECT doc_id, i, n, item_id FROM places JOIN grams USING (n, g)),
counts AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN counts USING (doc_id) LEFT JOIN named USING (doc_id)"""


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), 4, 85)


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.captures(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op3_warc"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS size FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, CAST(size AS BIGINT) AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN size >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN size >= 1000 AND page_id <> top THEN top END AS refers_to
FROM m"""


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, action string")
    return url_filters.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).select("page_id", "host", "path", "rule", "verdict")


ORACLES["op4_url_filters"] = r"""
WITH rules(h, p, action) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
                             ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
parts AS (SELECT page_id,
    translate(regexp_extract(coalesce(url, ''), '^(.*?)://([^/?#]*)', 2, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '^.*?://[^/?#]*([^?#]*)', 1, 's') AS path FROM pages),
fits AS (SELECT parts.*, h || p AS rule, action,
    row_number() OVER (PARTITION BY page_id ORDER BY h IS NULL, length(h || p) DESC, length(h) DESC) AS rank
  FROM parts LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM fits WHERE rank = 1"""


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.train(docs, labels.where(toxicity.fold(F.col("doc_id")) != 0))
    return toxicity.score_toxicity(docs, model).select(
        "doc_id", F.coalesce(toxicity.fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.stored_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = unigram.load(public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    back = unigram.decode(unigram.encode(docs, model), model)
    return back.select(
        "doc_id", F.size("ids").alias("n_pieces"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), (F.col("decoded") == F.col("text")).alias("lossless"))


def _only(kind: str):
    return lambda k: F.when(k == kind, k)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_pii(docs, pii.train(docs))
    joined = {c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",") for c in ("base", "spans")}
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.array_compact(F.transform(kinds, _only(k)))).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined["base"], 256).alias("base_sha256"), joined["spans"].alias("spans"))


def op10_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links.link_vectors(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), 0.9).select(
        "vec_id", "n_links", "component_id", "kept")


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), 2048)
    return placed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """``docs`` in which the words of every tenth document repeat from some word on, as the contract sets; a null id is left alone."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10).cast("long")
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    sized = docs.withColumn("_words", F.when(h % 10 == 0, words)).withColumns({"_n": F.size("_words"), "_g": g})
    placed = sized.withColumn("_a", F.when(F.col("_n") > 0, (F.col("_g") % F.col("_n")).cast("int")))
    n, a = F.col("_n"), F.col("_a")
    placed = placed.withColumn("_p", 1 + F.floor((n - a) / (3 + F.col("_g") % 8)).cast("int"))
    period = F.slice("_words", a + 1, F.col("_p"))
    tail = F.slice(F.flatten(F.array_repeat(period, F.ceil((n - a) / F.col("_p")).cast("int"))), F.lit(1), n - a)
    text = F.when(a.isNotNull(), F.array_join(F.concat(F.slice("_words", F.lit(1), a), tail), " ")).otherwise(F.col("text"))
    return placed.withColumn("text", text).select(*docs.columns)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(with_planted_periods(table(spark, sf_dir, "documents").select("doc_id", "text")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n"))), "")
    best = found.withColumn("_top", longest)
    length, period = F.col("_top.length"), -F.col("_top.period")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("_top.start")).alias("start"), length.alias("length"), period.alias("period"),
        F.expr("1000 * _top.length div -_top.period").alias("exponent_milli"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    books = vector_codes.train_codebooks(vectors)
    coded = vector_codes.with_label_error(vector_codes.encode(vectors, books).drop("embedding"))
    return coded.select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(vector_codes.digest(books)).alias("codebooks_sha256"))


def _assigned(books: str) -> str:
    return f"""SELECT vec_id, label, p, any_value(x) AS x, arg_min(e, d * 64 + e) AS e, min(d) AS d
FROM (SELECT vec_id, label, p, x, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM parts JOIN {books} USING (p))
GROUP BY vec_id, label, p"""


def _moved(books: str, assigned: str) -> str:
    return f"""SELECT p, e, coalesce(m, c) AS c FROM {books} LEFT JOIN (
  SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m
  FROM (SELECT p, e, i, sum(x[i]) AS s, count(*) AS n FROM {assigned}, unnest(range(1, len(x) + 1)) AS u(i) GROUP BY p, e, i) GROUP BY p, e) USING (p, e)"""


# Vectors of one number of components and distinct ids, as the given tables have them.
ORACLES["op13_vector_codes"] = f"""
WITH kept AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
              WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT vec_id, label, p, v[p * len(v) // 16 + 1 : (p + 1) * len(v) // 16] AS x FROM kept, unnest(range(16)) AS u(p)),
c0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS c FROM parts QUALIFY e < 64),
a0 AS MATERIALIZED ({_assigned("c0")}),
c1 AS MATERIALIZED ({_moved("c0", "a0")}),
a1 AS MATERIALIZED ({_assigned("c1")}),
c2 AS MATERIALIZED ({_moved("c1", "a1")}),
a2 AS MATERIALIZED ({_assigned("c2")}),
coded AS (SELECT vec_id, label, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM a2 GROUP BY vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM c2) AS codebooks_sha256
FROM coded"""


def queries() -> dict:
    return {name: made for name, made in globals().items() if name.startswith("op")}

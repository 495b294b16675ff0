"""Columns of the input that are named like something inside an operator stay, with their values."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from textlab.llm import decontamination, embedding_links, suffix_dedup, toxicity

PASSAGE = "a passage of more than one hundred bytes that both documents hold, so that the later one of the two loses it whole"
TEXTS = [(1, f"first {PASSAGE}"), (2, f"second {PASSAGE}"), (3, "short item"), (4, None), (4, None), (5, "")]


def with_columns(df, names, key="doc_id"):
    return df.withColumns({name: F.concat(F.lit(f"{name}:"), F.coalesce(F.col(key).cast("string"), F.lit("-"))) for name in names})


def assert_kept(got, names, key="doc_id"):
    rows = got.collect()
    assert rows
    for row in rows:
        assert [row[n] for n in names] == [f"{n}:{row[key]}" for n in names]
    return rows


@pytest.mark.parametrize("budget", [decontamination.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("action", ["drop", "spans"])
def test_decontamination(spark, monkeypatch, budget, action):
    names = ["content", "candidates", "Hash", "window", "_own_content", "first"]
    docs = with_columns(spark.createDataFrame(TEXTS, "doc_id long, text string"), names)
    items = spark.createDataFrame([("a", "short item")], "item_id string, text string")
    found = decontamination.find_contamination(docs, items, broadcast_bytes=budget)
    assert {r.doc_id: r.n_hit for r in assert_kept(found, names)} == {1: 0, 2: 0, 3: 2, 4: 0, 5: 0}
    monkeypatch.setattr(decontamination.find_contamination, "__defaults__", (*decontamination.find_contamination.__defaults__[:-1], budget))
    cleaned = decontamination.decontaminate(docs, items, action)
    assert cleaned.columns == docs.columns
    assert len(assert_kept(cleaned, names)) == (5 if action == "drop" else 6)


def test_suffix_dedup(spark):
    names = ["h", "own_id", "first_id", "Ranges", "places", "n", "_own_h"]
    docs = with_columns(spark.createDataFrame(TEXTS, "doc_id long, text string"), names)
    got = suffix_dedup.remove_repeats(docs)
    assert got.columns == [*docs.columns, "kept", "n_bytes", "n_removed", "n_spans"]
    assert {(r.doc_id, r.n_removed, r.n_spans) for r in assert_kept(got, names)} == {
        (1, 0, 0), (2, len(PASSAGE) + 1, 1), (3, 0, 0), (4, 0, 0), (5, 0, 0)}


@pytest.mark.parametrize("vector", ["embedding", "v", "n"])
def test_embedding_links(spark, vector):
    names = [n for n in ("v", "n", "first", "id", "row", "key", "copies", "Component") if n != vector]
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0]), (4, None), (5, [1.0, 0.0])]
    table = with_columns(spark.createDataFrame(rows, f"vec_id long, {vector} array<double>"), names, "vec_id")
    got = embedding_links.link_vectors(table, vector=vector)
    assert got.columns == [*table.columns, "n_links", "component_id", "kept"]
    found = assert_kept(got, names, "vec_id")
    assert sorted((r.vec_id, r[vector], r.n_links, r.component_id, r.kept) for r in found if r[vector]) == [
        (1, [1.0, 0.0], 2, 1, True), (2, [1.0, 0.1], 2, 1, False), (3, [0.0, 1.0], 0, 3, True), (5, [1.0, 0.0], 2, 1, False)]
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in found if not r[vector]] == [(4, 0, 4, True)]


def test_toxicity_stage(spark, monkeypatch, tmp_path):
    names = ["score", "score_", "_own_score"]
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    monkeypatch.setattr(toxicity, "train", lambda docs, labels: None)
    monkeypatch.setattr(toxicity, "score_toxicity", lambda docs, model: docs.drop("score").withColumn("score", F.when(F.col("doc_id") == 3, 0.9).otherwise(0.1)))
    docs = with_columns(spark.createDataFrame(TEXTS, "doc_id long, text string"), names)
    got = corpus_pipeline.toxic(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    assert sorted(r.doc_id for r in assert_kept(got, names)) == [1, 2, 4, 4, 5]

"""The stored index against exact search."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from queries import views
from textlab.operators import search
from textlab.sources import vector_index
from textlab.sources.vector_index import VectorIndex


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    rows = views.vectors(spark, "/root/testdata/sf0.01").cache()
    return rows, VectorIndex.build(rows, str(tmp_path_factory.mktemp("index") / "i"))


def asked(rows):
    return rows.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))


def hits(df):
    return {(r.query_id, r.chunk_id): r.score for r in df.collect()}


def test_recall_of_the_defaults(spark, stored):
    rows, index = stored
    want, got = hits(search.search_batch(rows, asked(rows), 5)), hits(index.search_batch(asked(rows), 5))
    assert len(got) == len(want)
    both = set(want) & set(got)
    assert len(both) / len(want) >= 0.9
    assert all(abs(want[x] - got[x]) < 1e-12 for x in both)
    assert vector_index.SHORTLIST * 5 < 0.2 * rows.count()  # rows of a query that are read and scored exactly


def test_all_lists_and_rows_give_the_exact_result(spark, stored):
    rows, index = stored
    lists = len(index.coder.centroids)
    assert hits(index.search_batch(asked(rows), 5, probes=lists, shortlist=500)) == pytest.approx(hits(search.search_batch(rows, asked(rows), 5)))
    query = list(rows.where("vec_id = 7").first().embedding)
    exact, found = search.search(rows, query, 7), index.search(query, 7, probes=lists, shortlist=500)
    assert found.columns == exact.columns
    assert [tuple(r) for r in found.collect()] == [tuple(r) for r in exact.collect()]


def test_a_query_reads_codes_of_its_lists_only(spark, stored):
    rows, index = stored
    plan = index.candidates(list(rows.first().embedding), 50, 3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_list" in plan and "ReadSchema: struct<chunk_id:string,_code:binary>" in plan
    own = index.candidates(list(rows.where("vec_id = 3").first().embedding), 50, 3).collect()
    assert "v3" in [r.chunk_id for r in own] and len({r._list for r in own}) <= 3


def test_filters_hold_before_the_cut(spark, stored):
    rows, index = stored
    where = search.filters(company="C3", high_priority_only=True)
    query = list(rows.where("vec_id = 7").first().embedding)
    lists = len(index.coder.centroids)
    assert [r.chunk_id for r in index.search(query, 5, where, lists, 500).collect()] == [r.chunk_id for r in search.search(rows, query, 5, where).collect()]
    got = index.search_batch(asked(rows), 3, where, lists, 500).groupBy("query_id").count().collect()
    assert len(got) == asked(rows).count() and {r["count"] for r in got} == {3}


def test_every_row_is_indexed_once_and_rows_can_follow(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(vector_index, "PART_ROWS", 4)
    monkeypatch.setattr(vector_index, "SCORES", 50)
    monkeypatch.setattr(vector_index, "QUERY_BYTES", 8 * 6 * 10)
    rng = np.random.default_rng(0)
    points = np.repeat(rng.normal(size=(20, 6)), 3, 0)
    points[30:] = points[30]  # half of all rows are one vector
    table = spark.createDataFrame([(i, [float(x) for x in v], "p") for i, v in enumerate(points)] + [(99, None, "p")], "id long, v array<double>, payload string")
    index = VectorIndex.build(table.where("id < 40 or id = 99"), str(tmp_path / "i"), "id", "v", lists=5, parts=3)
    index.append(table.where("id >= 40 and id < 99"))
    index = VectorIndex(spark, str(tmp_path / "i"), "id", "v")
    assert sorted(r.id for r in index.read().collect()) == list(range(60))
    queries = table.where("v is not null").select(F.col("id").alias("query_id"), F.col("v").alias("query_vector"))
    got = [(r.query_id, r["rank"], round(r.score, 9)) for r in index.search_batch(queries, 4, probes=5, shortlist=60).collect()]
    want = [(r.query_id, r["rank"], round(r.score, 9)) for r in search.search_batch(table.where("v is not null"), queries, 4, key="id", vector="v").collect()]
    assert sorted(got) == sorted(want)
    with pytest.raises(ValueError, match="no vectors"):
        VectorIndex.build(table.where("v is null"), str(tmp_path / "none"), "id", "v")
    with pytest.raises(ValueError, match="7 entries, not 6"):
        index.search([1.0] * 7)
    with pytest.raises(Exception, match="does not have 6 entries"):
        index.append(spark.createDataFrame([(1, [1.0], "p")], table.schema))


def test_queries_travel_once_with_all_their_lists():
    rng = np.random.default_rng(1)
    coder = vector_index.Coder(rng.normal(size=(200, 8)), rng.normal(size=(2, 256, 4)))
    queries = rng.normal(size=(1000, 8))
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(1000)), pa.array(queries.tolist())], names=["_q", "_v"])
    made = list(vector_index.routed([batch], coder, 120, 20_000))
    assert max(b.num_rows for b in made) == 100  # 20,000 distances at once
    assert sum(b.nbytes for b in made) < 2 * batch.nbytes + 1000 * 120 * 4  # vectors are not repeated for every list
    assert [x for b in made for x in b["_q"].to_pylist()] == list(range(1000))
    assert [x for b in made for x in b["_lists"].to_pylist()] == coder.probes(queries, 120).tolist()

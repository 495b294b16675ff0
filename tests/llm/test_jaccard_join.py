import glob
import random
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from textlab.llm import jaccard_join
from textlab.llm.staging import SHUFFLE_CLEANUP, staged
from textlab.llm.words import slices


def test_shingles_are_made_of_small_pieces_of_a_batch():
    rng = random.Random(5)
    texts = [" ".join(rng.choice("abcdefgh") for _ in range(1000)) for _ in range(1000)]  # 2 MB of words of one letter
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    tracemalloc.start()
    try:
        parts = [jaccard_join.shingle_sets(part.column("text"), 4)[2] for part in slices([batch], limit=jaccard_join.SLICE)]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 32 << 20  # 64 MB with pieces of 1 MiB
    assert np.concatenate(parts).tolist() == jaccard_join.shingle_sets(batch.column("text"), 4)[2].tolist()


@pytest.fixture
def no_broadcast(spark):
    """As on large inputs: nothing is small enough for the planner to broadcast it by itself."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def shuffled_text(spark, docs, monkeypatch):
    """How many tables were staged whose plan shuffles texts, and the result."""
    plans = []

    def watched(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return staged(df, name)

    monkeypatch.setattr(jaccard_join, "staged", watched)
    rows = sorted(map(tuple, jaccard_join.jaccard_components(docs, 4, 85).collect()))
    return [name for name, plan in plans if "SortMergeJoin [doc_id" in plan and "text" in plan], rows


def test_sieves_do_not_shuffle_texts(spark, no_broadcast, monkeypatch):
    """Before, the semi joins before the second sieve and before the shingles each shuffled all texts, once the ids were too many for a broadcast."""
    rng = random.Random(7)
    base = [" ".join(rng.choice("abcdefghij") + str(rng.randrange(40)) for _ in range(60)) for _ in range(40)]
    docs = spark.createDataFrame([(i, base[i % 40] + (" x" if i % 3 else "")) for i in range(120)] + [(500 + i, f"alone {i} b{i} c{i} d{i}") for i in range(200)], "doc_id long, text string")
    names, rows = shuffled_text(spark, docs, monkeypatch)
    assert names == []
    monkeypatch.setattr(jaccard_join, "FILTER_WORDS", 0)  # the exact join, for more ids than the filter is made for
    joined, same = shuffled_text(spark, docs, monkeypatch)
    assert joined and same == rows
    # One word for all ids lets every text through, copies of the chosen ones too.
    monkeypatch.setattr(jaccard_join, "FILTER_WORDS", 1)
    monkeypatch.setattr(jaccard_join, "WORD_IDS", 1 << 30)
    assert shuffled_text(spark, docs, monkeypatch) == ([], rows)
    assert {c for d, _, c in rows if d < 120} == set(range(40)) and all(d == c for d, _, c in rows if d >= 500)


def test_filter_of_ids_loses_none_and_lets_few_others_through(spark):
    rows = spark.range(-20000, 20000).withColumnRenamed("id", "doc_id")
    ids = rows.where("pmod(doc_id, 7) = 0")
    count = ids.count()
    kept = {r.doc_id for r in jaccard_join.among(rows, ids, count).collect()}
    assert kept >= {r.doc_id for r in ids.collect()}
    assert len(kept) - count < 0.08 * (40000 - count)
    assert jaccard_join.among(rows, ids.limit(0), 0).count() == 0


def test_staged_tables_leave_no_shuffle_files(spark):
    files = lambda: set(glob.glob(f"{spark.conf.get('spark.local.dir', '/tmp')}/blockmgr-*/*/shuffle_*.data"))
    before, setting = files(), spark.conf.get(SHUFFLE_CLEANUP)
    table = staged(spark.range(5000).selectExpr("id % 100 AS k").groupBy("k").count(), "counts")
    deadline = time.time() + 20
    while files() - before and time.time() < deadline:
        time.sleep(0.2)
    assert files() - before == set()
    assert table.count() == 100 and spark.conf.get(SHUFFLE_CLEANUP) == setting

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from textlab.operators import sampling


def digest(key, seed=42):
    return hashlib.md5(f"{seed}|{key}".encode()).hexdigest()


def frame(spark, n=500):
    return spark.range(n).selectExpr("id", "cast(case when id % 3 = 0 then 0 else id % 7 end as int) as label")


def test_sample_is_exact_and_repeatable(spark):
    got = {r.id for r in sampling.sample_n(frame(spark), 60, ["id"]).collect()}
    assert got == set(sorted(range(500), key=digest)[:60])
    other = {r.id for r in sampling.sample_n(frame(spark).repartition(7), 60, ["id"]).collect()}
    assert got == other
    assert got != {r.id for r in sampling.sample_n(frame(spark), 60, ["id"], seed=1).collect()}


@pytest.mark.parametrize("n", [0, None, 500, 900])
def test_sample_off_or_everything(spark, n):
    assert sampling.sample_n(frame(spark), n, ["id"]).count() == 500


def jobs(spark, name, run):
    """What ``run`` returns and the number of jobs it started."""
    spark.sparkContext.setJobGroup(name, name)
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_small_samples_read_their_rows_once_for_the_cut(spark):
    rows = frame(spark).repartition(5).cache()
    rows.count()
    for name, make in (("one", lambda: sampling.sample_n(rows, 60, ["id"])), ("strata", lambda: sampling.stratified(rows, 100, ["label"], ["id"]))):
        made, started = jobs(spark, f"sample-{name}", make)
        assert started <= 2
        assert made.count() in (60, 102, 101, 100, 103, 104)


@pytest.mark.parametrize("kept", [1, 3, 50])
def test_hashes_are_cut_between_batches_and_merged_over_tasks(spark, kept):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        rows = spark.range(200_000).selectExpr("id", "id % 3 as g", "cast(null as string) as s").repartition(3)
        hashes, made = sampling.smallest_hashes(rows, ["g", "s"], ["id"], 42, kept)
        assert made <= 3 * 3 * (kept + 1) and hashes.agg({"_rows": "sum"}).first()[0] == 200_000
        got = {r.id for r in sampling.sample_n(rows, kept, ["id"]).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == set(sorted(range(200_000), key=digest)[:kept])


def test_large_samples_are_cut_by_hash_prefixes(spark, monkeypatch):
    want = [{r.id for r in sampling.sample_n(frame(spark), 60, ["id"]).collect()}, {r.id for r in sampling.stratified(frame(spark), 90, ["label"], ["id"]).collect()}]
    monkeypatch.setattr(sampling, "BOTTOM_ROWS", 0)
    assert [{r.id for r in sampling.sample_n(frame(spark), 60, ["id"]).collect()}, {r.id for r in sampling.stratified(frame(spark), 90, ["label"], ["id"]).collect()}] == want


def test_narrowing_steps_give_the_same_cut(spark, monkeypatch):
    monkeypatch.setattr(sampling, "BOTTOM_ROWS", 0)
    monkeypatch.setattr(sampling, "RANK_ROWS", 2)
    monkeypatch.setattr(sampling, "PREFIX", 1)
    got = {r.id for r in sampling.sample_n(frame(spark), 123, ["id"]).collect()}
    assert got == set(sorted(range(500), key=digest)[:123])
    flagged = sampling.split_flag(frame(spark), ["label"], ["id"])
    assert {r.id for r in flagged.filter("is_test").collect()} == expected_test(spark)


def expected_test(spark):
    labels = {r.id: r.label for r in frame(spark).collect()}
    chosen = set()
    for label, size in Counter(labels.values()).items():
        members = sorted((i for i in labels if labels[i] == label), key=digest)
        chosen |= set(members[: int(size * 0.2 + 0.5)])
    return chosen


def test_stratified_split(spark):
    train, test = sampling.stratified_split(frame(spark), ["label"], ["id"])
    assert {r.id for r in test.collect()} == expected_test(spark)
    assert train.count() + test.count() == 500


def test_hashed_split_is_disjoint_and_near_the_share(spark):
    train, test = sampling.stratified_split(frame(spark, 20_000), ["label"], ["id"], exact=False)
    assert train.count() + test.count() == 20_000
    assert abs(test.count() - 4_000) < 300


def test_stratified_sizes(spark):
    rows = spark.range(1000).selectExpr("id", "case when id < 5 then 's' when id < 60 then 'm' else null end as g")
    sizes = Counter(r.g for r in sampling.stratified(rows, 100, ["g"], ["id"]).collect())
    assert sizes == {"s": 5, "m": 10, None: 94}
    assert sampling.stratified(rows, 2000, ["g"], ["id"]).count() == 1000


def test_empty(spark):
    assert sampling.sample_n(frame(spark, 0), 5, ["id"]).count() == 0
    assert sampling.split_flag(frame(spark, 0), ["label"], ["id"]).count() == 0


def test_a_task_holds_little_more_than_it_keeps(monkeypatch):
    monkeypatch.setattr(sampling, "CUT_ROWS", 1000)
    held, before = [], pa.total_allocated_bytes()

    def batches():
        for i in range(400):
            held.append(pa.total_allocated_bytes() - before)
            ids = np.arange(i * 500, (i + 1) * 500)
            at = pa.StructArray.from_arrays([pa.array([digest(x) for x in ids.tolist()]), pa.array(ids)], names=["h", "k"])
            yield pa.RecordBatch.from_arrays([pa.array((ids % 100).astype(str)), at], names=["_stratum", "_at"])

    made = list(sampling.kept_hashes(batches(), 1, 50))
    assert max(held) < 100 * 50 * 2 * 60  # twice the rows that are kept, of 60 bytes; four times and 65,536 rows were held before
    got = sorted((r["_stratum"], r["_at"]["k"]) for b in made for r in b.to_pylist() if r["_at"])
    assert got == sorted((str(g), x) for g in range(100) for x in sorted(range(g, 200_000, 100), key=digest)[:50])
    assert sum(r["_rows"] or 0 for b in made for r in b.to_pylist()) == 200_000

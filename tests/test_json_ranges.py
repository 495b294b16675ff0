import json
import random

import pytest
from pyspark.sql import functions as F

from textlab.schemas import WINE_FEATURES
from textlab.sources import json_ranges
from textlab.sources.files import read_requests


def records(n, seed=0):
    rng = random.Random(seed)
    return [{f: round(rng.uniform(0, 9), rng.randint(0, 4)) for f in WINE_FEATURES} for _ in range(n)]


def odd(record, text):
    return {"note": text, "inner": {"deep": [1, {"x": "]}{["}], "text": text}, **record}


MANY = records(60)
FILES = {
    "plain.json": json.dumps({"wines": MANY}),
    "indented.json": json.dumps({"wines": MANY[:20]}, indent=3) + "\n\n",
    "with_more.json": json.dumps({"id": 7, "tags": ["a", "}", {}][:2], "wines": [odd(r, 'é "quoted" \\ } ] { [ \\"') for r in MANY[:25]], "meta": {"a": [1, 2]}}),
    "one.json": json.dumps({"wines": MANY[:1]}),
    "none.json": json.dumps({"wines": []}),
    "null.json": json.dumps({"wines": None}),
    "array_elsewhere.json": json.dumps({"other": MANY[:9], "wines": MANY[:11]}),
    "null_record.json": json.dumps({"wines": [MANY[0], None, MANY[1]]}),
    "nested.json": json.dumps({"wines": [MANY[:5]]}),
    "empty.json": "",
    "blank.json": " \n ",
    "mark.json": "﻿" + json.dumps({"wines": MANY[:10]}),
    "cut.json": json.dumps({"wines": MANY[:30]})[:-40],
    "cut_in_string.json": json.dumps({"wines": [odd(r, "}}") for r in MANY[:9]]})[:-17].rpartition('"')[0],
    "no_end.json": json.dumps({"wines": MANY[:12]})[:-1],
    "words.json": "no json at all } {",
    "long_text.json": json.dumps({"wines": [odd(MANY[0], "x}" * 2000), MANY[1]]}),
    "a name, with space.json": json.dumps({"wines": MANY[:3]}),
}


def rows(df):
    return sorted((tuple(r[c] for c in ("batch_id", "position", *WINE_FEATURES, "problem")) for r in df.collect()), key=str)


@pytest.fixture
def small_ranges(spark):
    names = {"spark.sql.files.maxPartitionBytes": None, "spark.sql.files.openCostInBytes": "1"}
    before = {n: spark.conf.get(n) for n in names}

    def use(size):
        for n, v in names.items():
            spark.conf.set(n, v or str(size))

    yield use
    for n, v in before.items():
        spark.conf.set(n, v)


@pytest.mark.parametrize("size", [149, 1 << 20])
def test_ranges_equal_one_task(spark, tmp_path, small_ranges, size):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text, encoding="utf-8")
    want = rows(read_requests(spark, str(tmp_path)))
    small_ranges(size)
    assert rows(json_ranges.read_requests_by_range(spark, str(tmp_path))) == want


def test_a_large_file_is_many_tasks(spark, tmp_path, small_ranges):
    (tmp_path / "big.json").write_text(FILES["plain.json"])
    small_ranges(500)
    got = json_ranges.read_requests_by_range(spark, str(tmp_path))
    ranges = len(FILES["plain.json"]) // 500
    assert json_ranges._pieces(spark, str(tmp_path)).select(F.spark_partition_id()).distinct().count() > ranges // 2
    assert [r.position for r in got.orderBy("position").collect()] == list(range(len(MANY)))
    assert [r.alcohol for r in got.orderBy("position").collect()] == [r["alcohol"] for r in MANY]


@pytest.mark.parametrize("small", [True, False])
def test_a_bad_record_leaves_the_others(spark, tmp_path, monkeypatch, small_ranges, small):
    if not small:  # states and counts meet the pieces by a shuffle
        monkeypatch.setattr(json_ranges, "small_side", lambda df: df.hint("shuffle_hash"))
    bad = [dict(r) for r in MANY[:20]]
    bad[7]["alcohol"] = "strong"
    (tmp_path / "bad.json").write_text(json.dumps({"wines": bad}))
    small_ranges(300)
    got = json_ranges.read_requests_by_range(spark, str(tmp_path)).orderBy("position").collect()
    assert [r.problem for r in got] == [None] * 7 + ["malformed record"] + [None] * 12
    assert [r.pH for r in got if r.position != 7] == [r["pH"] for i, r in enumerate(bad) if i != 7]

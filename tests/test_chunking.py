import random

import pytest
from pyspark.sql import functions as F

from textlab.operators.chunking import chunk_stats, chunks
from textlab.operators.enrich import enrich, with_priority
from textlab.schemas import section_dimension

SCHEMA = "docID string, section int, sentenceID long, sentence string, name string, reportDate date, cik string"


def sentences(spark, groups, shuffle=7):
    rows = [
        (doc, section, i, text, f"co{i}", None, f"cik{doc}")
        for (doc, section), texts in groups.items() for i, text in enumerate(texts)
    ]
    random.Random(shuffle).shuffle(rows)
    return with_priority(spark.createDataFrame(rows, SCHEMA), section_dimension(spark))


def run(spark, groups, **options):
    made = chunks(sentences(spark, groups), section_dimension(spark), **options)
    return {r.chunk_id: r for r in made.collect()}


def expected(groups, w=3, stride=2, limit=2000, keep_tail=True):
    """Plain restatement of the rules."""
    out = {}
    for (doc, section), texts in groups.items():
        base = f"{doc}_sec{section}"
        if len(texts) < w:
            out[f"{base}_full"] = (" ".join(texts), None)
            continue
        starts = list(range(0, len(texts) - w + 1, stride))
        if keep_tail and starts[-1] + w < len(texts) and starts[-1] + stride < len(texts):
            starts.append(starts[-1] + stride)
        for start in starts:
            part = texts[start:start + w]
            joined = " ".join(part)
            if len(joined) <= limit:
                out[f"{base}_chunk{start}"] = (joined, False)
                continue
            packed, current = [], ""
            for text in part:
                if len(current) + len(text) < limit:
                    current = f"{current} {text}" if current else text
                else:
                    packed += [current] if current else []
                    current = text
            packed += [current] if current else []
            for j, text in enumerate(packed):
                out[f"{base}_chunk{start}_part{j}"] = (text, True)
    return out


def random_groups(seed, n=60, longest=30):
    rng = random.Random(seed)
    return {
        (f"d{i}", rng.choice([0, 1, 10, 19, 15, None])): [
            "x" * rng.choice([0, 1, 5, 15, 30, 70]) for _ in range(rng.randint(1, longest))]
        for i in range(n)
    }


def test_five_sentences(spark):
    got = run(spark, {("d", 1): list("ABCDE")})
    assert {k: r.text for k, r in got.items()} == {"d_sec1_chunk0": "A B C", "d_sec1_chunk2": "C D E"}
    first = got["d_sec1_chunk0"]
    assert (first.company, first.priority, first.section_name, first.n_sentences, first.char_count, first.is_split) == (
        "co0", "high", "Risk Factors", 3, 5, False)
    assert got["d_sec1_chunk2"].company == "co0"


def test_tail(spark):
    groups = {("d", 1): list("ABCD")}
    assert {r.text: r.n_sentences for r in run(spark, groups).values()} == {"A B C": 3, "C D": 2}
    assert {r.text for r in run(spark, groups, keep_tail=False).values()} == {"A B C"}


def test_short_group_is_never_split(spark):
    got = run(spark, {("d", 77): ["a" * 30, "b" * 30]}, max_chars=40)
    row = got["d_sec77_full"]
    assert (row.text, row.is_split, row.n_sentences) == ("a" * 30 + " " + "b" * 30, None, 2)
    assert (row.section_name, row.priority) == ("Section_77", "unknown")


def test_packing_does_not_count_the_space(spark):
    got = run(spark, {("d", 1): ["a" * 15, "b" * 15, "c" * 15]}, max_chars=40)
    assert {k: len(r.text) for k, r in got.items()} == {"d_sec1_chunk0_part0": 31, "d_sec1_chunk0_part1": 15}
    assert all(r.is_split and r.n_sentences == 3 for r in got.values())


def test_overlong_sentence_stays_whole(spark):
    got = run(spark, {("d", 1): ["a", "b" * 90, "c"]}, max_chars=40)
    assert [got[f"d_sec1_chunk0_part{j}"].text for j in range(3)] == ["a", "b" * 90, "c"]


@pytest.mark.parametrize("seed,w,stride,limit,hot", [
    (1, 3, 2, 60, None), (2, 3, 2, 2000, 1000), (3, 4, 1, 80, None), (4, 2, 3, 40, None),
    (5, 3, 2, 60, 6), (6, 4, 1, 80, 6), (7, 2, 3, 40, 3), (8, 3, 5, 70, 1),
])
def test_random_groups(spark, seed, w, stride, limit, hot):
    groups = random_groups(seed)
    got = run(spark, groups, w=w, stride=stride, max_chars=limit, hot_rows=hot)
    assert {k: (r.text, r.is_split) for k, r in got.items()} == expected(groups, w, stride, limit)
    assert all(r.company == "co0" for r in got.values())


def test_hot_group_beside_small_ones(spark):
    groups = {("hot", 10): [f"s{i}" for i in range(500)], **random_groups(9, 20, 8)}
    got = run(spark, groups, hot_rows=50)
    assert {k: (r.text, r.is_split) for k, r in got.items()} == expected(groups)


def test_ordinary_groups_need_one_shuffle(spark):
    df = sentences(spark, {("d", 1): list("ABCDE")})
    plan = chunks(df, section_dimension(spark), hot_rows=None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan


def test_stats(spark):
    df = sentences(spark, {("d", 1): ["a" * 15, "b" * 15, "c" * 15]})
    made = chunks(df, section_dimension(spark), max_chars=40)
    assert tuple(chunk_stats(made).first()) == (2, 15, 31, 23.0, 2)
    assert tuple(chunk_stats(made.limit(0)).first()) == (0, None, None, None, 0)


def test_enrich(spark):
    rows = spark.createDataFrame(
        [("d", 1, 0, "one two three 1 2 3", "n"), ("d", 55, 1, "NA .", "n"), ("d", None, 2, "a b c", "n")],
        "docID string, section int, sentenceID long, sentence string, filingDate string",
    )
    got = {r.sentenceID: r for r in enrich(rows, section_dimension(spark)).collect()}
    assert set(got) == {0, 2}
    assert (got[0].section_priority, got[0].likely_table, got[0].is_fragment) == ("high", True, True)
    assert got[2].section_priority is None
    assert "filingDate" not in got[0].asDict()
    assert enrich(rows, section_dimension(spark), sample_size=1).count() == 1
    assert enrich(rows, section_dimension(spark), min_tokens=1).filter(F.col("section") == 55).first()[
        "section_priority"] == "unknown"


@pytest.mark.parametrize("hot_rows", [None, 4])
def test_every_sentence_is_in_a_chunk(spark, hot_rows):
    groups = {(f"d{n}", 1): [f"s{n}x{i}e" for i in range(n)] for n in range(1, 14)}
    made = run(spark, groups, hot_rows=hot_rows)
    held = " ".join(r.text for r in made.values())
    assert all(text in held for texts in groups.values() for text in texts)
    assert {k: (r.text, r.is_split) for k, r in made.items()} == expected(groups)

"""Runs of repeated words against a search over all periods."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textlab.llm import periodic_runs
from textlab.llm import queries as llm


def all_runs(w):
    """(start, length, period) of every maximal repetition of two or more smallest periods, by trying every period."""
    n, out = len(w), set()
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            length = i - start + q
            if length >= 2 * q and not any(all(w[x] == w[x + p] for x in range(start, start + length - p)) for p in range(1, q)):
                out.add((start, length, q))
            i += 1
    return out


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=45))
def test_maximal_runs(word):
    got = periodic_runs.maximal_runs(np.array(word, np.int64))
    assert len(got) == len(set(got)) and set(got) == all_runs(word)


@pytest.mark.parametrize("kind", ["fibonacci", "power", "blocks"])
def test_maximal_runs_of_regular_words(kind, monkeypatch):
    a, b = [0], [0, 1]
    while len(b) < 200:
        a, b = b, b + a
    word = {"fibonacci": b, "power": [0] * 150, "blocks": ([0, 1, 0, 0, 1] * 9 + [2]) * 4}[kind]
    plain = sorted(periodic_runs.maximal_runs(np.array(word)))
    assert set(plain) == all_runs(word)
    monkeypatch.setattr(periodic_runs, "COMPACT", 0)
    assert sorted(periodic_runs.maximal_runs(np.array(word))) == plain


@pytest.mark.parametrize("seed", range(6))
def test_stretches_lose_no_run(seed):
    rng = random.Random(seed)
    docs = []
    for _ in range(60):
        w = [rng.randrange(rng.choice([2, 5, 40])) for _ in range(rng.randint(0, 60))]
        if w and rng.random() < 0.6:
            a = rng.randrange(len(w))
            p = 1 + (len(w) - a) // rng.randint(3, 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, len(w))]
        docs.append(w)
    flat, bounds = np.array([c for w in docs for c in w], np.int64), np.concatenate([[0], np.cumsum([len(w) for w in docs])])
    for length, exponent in ((6, 4), (2, 2), (9, 3)):
        got = {(a + s, n, q) for a, b in zip(*(x.tolist() for x in periodic_runs.stretches(flat, bounds, length, exponent)))
               for s, n, q in periodic_runs.maximal_runs(flat[a:b]) if n >= max(length, exponent * q)}
        assert got == {(bounds[i] + s, n, q) for i, w in enumerate(docs) for s, n, q in all_runs(w) if n >= max(length, exponent * q)}


def test_long_stretch_with_a_long_period():
    rng = random.Random(1)
    base = [rng.randrange(50) for _ in range(15_000)]
    word = np.array(base * 4 + base[:7], np.int64)
    runs = [r for r in periodic_runs.maximal_runs(word) if r[1] >= 4 * r[2] and r[1] >= 6 and r[2] > 100]
    assert runs == [(0, len(word), 15_000)]


def expected(doc, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n = len(w)
    if doc is not None and n:
        h = zlib.crc32(str(doc).encode())
        g = h // 10
        if h % 10 == 0:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = sorted(r for r in all_runs(w) if r[1] >= max(6, 4 * r[2]))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            digest("".join("%d,%d,%d\n" % r for r in runs)), digest(" ".join(x for i, x in enumerate(w) if i not in gone)))


def texts():
    rng = random.Random(3)
    made = [None, "", " \t ", "a", "ha " * 6, "ha " * 5, "\x0bx\x0cy\r\nx y x y x y  x y x", "é é é é " * 4, "na " * 300 + "b " * 300]
    made += [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 120))) for _ in range(150)]
    made += [" ".join(["line", "of", "words"] * rng.randint(1, 9) + [rng.choice("xyz")] + ["q"] * rng.randint(0, 9)) for _ in range(50)]
    return made


def test_query(spark, tmp_path):
    rows = list(enumerate(texts())) + [(None, "ha ha ha ha ha ha"), (5, "ha " * 6), (5, "ha " * 6)]
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in rows) > 10
    spark.createDataFrame([(d, t, "en") for d, t in rows], "doc_id long, text string, lang string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = llm.op12_periodic_runs(spark, str(tmp_path))
    assert [c for c, t in got.dtypes if t == "bigint"] == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((expected(d, t) for d, t in rows), key=str)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert llm.op12_periodic_runs(spark, f"{tmp_path}/none").count() == 0


def test_other_columns_stay(spark):
    docs = spark.createDataFrame([(1, "ha " * 6, "r", None, 2), (None, None, None, 3, None)], "doc_id long, text string, runs string, start long, `odd name` int")
    got = periodic_runs.find_runs(docs)
    assert got.columns == ["doc_id", "text", "start", "odd name", "n_words", "runs", "collapsed"]
    rows = {r.doc_id: r for r in got.collect()}
    assert (rows[1].n_words, [tuple(x) for x in rows[1].runs], rows[1].collapsed, rows[1]["odd name"]) == (6, [(0, 6, 1)], "ha", 2)
    assert (rows[None].n_words, rows[None].runs, rows[None].collapsed, rows[None].start) == (0, [], "", 3)
    few = periodic_runs.find_runs(spark.createDataFrame([(1, "a b a b c c")], "doc_id long, text string"), least_length=2, least_exponent=2).first()
    assert [tuple(r) for r in few.runs] == [(0, 4, 2), (4, 2, 1)]

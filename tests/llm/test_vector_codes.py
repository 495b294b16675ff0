"""Vector codes against plain loops over all entries."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textlab.llm import queries as llm
from textlab.llm import vector_codes

INF, NAN = float("inf"), float("nan")


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 64), st.integers(1, 4), st.integers(1, 40), st.integers(0, 10**6))
def test_nearest_entry(entries, dims, spread, seed):
    rng = np.random.default_rng(seed)
    book, points = rng.integers(-spread, spread + 1, (entries, dims)), rng.integers(-2 * spread, 2 * spread + 1, (50, dims))
    found, distance = vector_codes.Slices(book).nearest(points)
    all_ = ((points[:, None] - book[None]) ** 2).sum(2)
    assert (found == all_.argmin(1)).all() and (distance == all_.min(1)).all()


def test_nearest_of_far_values():
    book = np.array([[-(1 << 28), 1 << 28], [1 << 28, 1 << 28], [0, 0]])
    found, distance = vector_codes.Slices(book).nearest(np.array([[1 << 28, -(1 << 28)], [(1 << 28) - 1, (1 << 28) - 1]]))
    assert found.tolist() == [2, 1] and distance.tolist() == [2 * (1 << 56), 2]
    with pytest.raises(ValueError):
        vector_codes.Slices(np.zeros((65, 2)))


def expected(rows, parts=16, entries=64, rounds=2):
    kept = [(k, [math.floor(256 * x) for x in v], label) for k, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] if r[0] is not None else 0, r[1]))
    width = len(kept[0][1]) // parts
    part = lambda v, p: v[p * width : (p + 1) * width]
    books = [[part(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [[] for _ in books[p]]
            for _, v, _ in kept:
                own[near(part(v, p), books[p])[1]].append(part(v, p))
            books[p] = [[sum(x) // len(m) for x in zip(*m)] if m else c for m, c in zip(own, books[p])]
    coded = []
    for k, v, label in kept:
        found = [near(part(v, p), books[p]) for p in range(parts)]
        coded.append((k, "".join("%02x" % e for _, e in found), sum(d for d, _ in found), label))
    total = {}
    for *_, error, label in coded:
        total[label] = total.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    return [(k, code, error, total[label], digest) for k, code, error, label in coded]


def vectors(n, seed=0, dim=32):
    rng = random.Random(seed)
    rows = [(i, [round(rng.uniform(-1, 1) * 64) / 64 for _ in range(dim)], rng.choice([1, 2, 3, None])) for i in range(n)]
    rng.shuffle(rows)
    odd = [(1000, None, 1), (1001, [0.5] * (dim - 1) + [None], 1), (1002, [NAN] * dim, 2), (1003, [INF] + [0.0] * (dim - 1), 2), (-1, [-INF] * dim, None), (1004, [], 1)]
    return rows + odd + [(1005, [0.25] * dim, 3), (1006, [0.25] * dim, 3), (None, [0.125] * dim, None), (1006, [0.25] * dim, 3)]


@pytest.mark.parametrize("n", [3, 90])
def test_query(spark, tmp_path, n):
    rows = vectors(n)
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = llm.op13_vector_codes(spark, str(tmp_path))
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(expected(rows), key=str)


def test_nothing_to_code(spark, tmp_path):
    spark.createDataFrame([(1, None, 1), (2, [NAN] * 16, 1)], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert llm.op13_vector_codes(spark, str(tmp_path)).count() == 0


def test_general_interface(spark):
    rows = [(f"k{k}", v, label, "c", 9.5, "x") for k, v, label in vectors(40, 3, 12)]
    table = spark.createDataFrame(rows, "name string, v array<double>, `odd label` int, code string, error double, _vector string").repartition(3)
    books = vector_codes.train_codebooks(table, "name", "v", parts=3, entries=8, rounds=4)
    assert books.shape == (3, 8, 4)
    coded = vector_codes.with_label_error(vector_codes.encode(table, books, "v"), "odd label")
    assert coded.columns == ["name", "v", "odd label", "_vector", "code", "error", "label_error"]
    back = vector_codes.decode(coded, books).collect()
    assert len(back) == sum(1 for _, v, *_ in rows if v and all(x is not None and math.isfinite(x) for x in v))
    for r in back:
        own = np.floor(np.array(r.v) * 256)
        assert r.error == int(((own - 256 * np.array(r.decoded)) ** 2).sum())
    with pytest.raises(ValueError):
        vector_codes.train_codebooks(table, "name", "v", parts=5)

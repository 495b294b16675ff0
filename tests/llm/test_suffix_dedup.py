"""Suffix ranks against sorting, removal against brute force."""

import random

import numpy as np

from textlab.llm import suffix_dedup


def brute(rows, length):
    seen, out = set(), {}
    texts = sorted({(-1 if d is None else d, t or "") for d, t in rows})
    for doc, text in texts:
        raw, gone = text.encode(), set()
        for i in range(len(raw) - length + 1):
            piece = raw[i : i + length]
            if piece in seen:
                gone.update(range(i, i + length))
            seen.add(piece)
        spans = sum(i - 1 not in gone for i in gone)
        out[doc, text] = bytes(b for i, b in enumerate(raw) if i not in gone), spans
    return out


def test_ranks():
    rng = random.Random(1)
    for n in range(0, 60):
        text = np.array([rng.randint(1, 2 + n % 3) for _ in range(n)], np.int64)
        ranks = suffix_dedup.suffix_ranks(text, 8)
        whole = sorted(range(n), key=lambda i: text[i:].tolist())
        assert [int(i) for i in np.argsort(ranks)] == whole


def corpus(rng):
    words = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 8))) for _ in range(300)]
    make = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, rows = make(40), []
    for i in range(60):
        text = make(rng.randint(0, 60))
        if i % 3 == 0:
            text = make(rng.randint(0, 9)) + passage[rng.randint(0, 30) :] + make(rng.randint(0, 9))
        rows.append((i, text))
    rows += [(100, rows[5][1]), (101, rows[6][1][:-1]), (102, "ab" * 200), (103, "x" * 500), (104, None), (105, ""), (106, rows[9][1][3:] + rows[9][1][3:]),
             (None, make(50)), (107, rows[3][1] * 3), (108, "y" * 99), (109, "y" * 99)]
    return rows


def test_against_brute_force(spark):
    rows = corpus(random.Random(7))
    rows.append(rows[0])
    want = brute(rows, 100)
    for hot in (suffix_dedup.HOT, 3):
        docs = spark.createDataFrame([(d, t, "z") for d, t in rows], "doc_id long, text string, kept string").repartition(5)
        got = suffix_dedup.remove_repeats(docs, hot=hot).collect()
        assert len(got) == len(rows)
        for r in got:
            kept, spans = want[-1 if r.doc_id is None else r.doc_id, r.text or ""]
            assert bytes(r.kept) == kept, (r.doc_id, hot)
            size = len((r.text or "").encode())
            assert (r.n_bytes, r.n_removed, r.n_spans) == (size, size - len(kept), spans)


def test_repeated_anchors_come_packed_by_text(spark):
    texts = {i: t for i, (_, t) in enumerate(corpus(random.Random(3))) if t and len(t.encode()) >= 100}
    found = {}
    for i, t in texts.items():
        row, place, code, _, _ = suffix_dedup.anchors(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))
        for p, c in set(zip(place.tolist(), code.tolist())):
            found.setdefault(c, set()).add((i, p))
    want = {i: sorted(p for own in found.values() if len(own) > 1 for j, p in own if j == i) for i in texts}
    rows = spark.createDataFrame(list(texts.items()) * 2, "h long, text string").repartition(3)
    for buckets, targets in ((1, 1), (3, 5)):
        got = suffix_dedup.repeated_anchors(rows, buckets, targets).collect()
        assert {r.h: sorted(r.places) for r in got} == {i: p for i, p in want.items() if p}
        assert len(got) == len({r.h for r in got})


def test_joined_ranges():
    got = suffix_dedup._joined(np.array([2, 1, 1, 1, 1]), np.array([3, 0, 5, 39, 200]), np.array([4, 30, 6, 50, 201]), 9)
    assert got.to_pylist() == [{"h": 1, "first": 0, "last": 50}, {"h": 1, "first": 200, "last": 201}, {"h": 2, "first": 3, "last": 4}]
    assert suffix_dedup._joined(*(np.zeros(0, np.int64),) * 3, 9).num_rows == 0


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(docs).count() == 0

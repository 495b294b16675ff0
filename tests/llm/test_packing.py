"""Packing against the library's own ids, a document-by-document best fit, and gapless sequences."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from textlab.llm import packing
from textlab.llm import queries as llm
from textlab.llm.word_ids import WordTokenizer

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, piece string, ids long, part int"
TEXTS = [
    None, "", " \t\n ", "One", "it's 12 o'clock — naïve É́ <|endoftext|>x", "a b c\x1cd\x0be", "ŞIİ ΣΑΣ ﬁ", "word " * 9000, "x" * 3000, "é" * 10,
    "the same", "the same", "line one\nline two\r\n" * 50,
]


def documents():
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma,", "delta.", "12", "epsilon's"]
    return [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id"), (3, "One")] + [(100 + i, " ".join(rng.choice(words) for _ in range(rng.randint(1, 1500)))) for i in range(120)]


def own_pieces(rows, capacity):
    """(doc_id, piece, start, length, crc) of every row by the library on the whole text."""
    library, out = Tokenizer.from_file(PATH), []
    for doc, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids + [0]
        out += [(doc, p, s, len(ids[s : s + capacity]), zlib.crc32(np.array(ids[s : s + capacity], "<u4").tobytes())) for p, s in enumerate(range(0, len(ids), capacity))]
    return out


def best_fit(lengths, capacity):
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(capacity - n)
    return len(rooms)


def check_places(places, capacity):
    """``places``: (sequence, offset, length); nothing overlaps, nothing is left open before the end."""
    held = defaultdict(list)
    for s, o, n in places:
        held[s].append((o, n))
    for own in held.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= capacity
    return len(held)


@pytest.mark.parametrize("seed", range(20))
def test_plan_equals_best_fit_of_documents(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 7, 64, 300])
    lengths = [rng.randint(1, capacity) if rng.random() < 0.7 else max(1, capacity // 3) for _ in range(rng.randint(0, 400))]
    counts, met, places = Counter(lengths), Counter(), []
    slots = packing.plan(counts, capacity)
    for n in lengths:
        s, o = slots.place(np.array([n]), np.array([met[n]]))
        places.append((int(s[0]), int(o[0]), n))
        met[n] += 1
    assert check_places(places, capacity) == best_fit(lengths, capacity)


def test_plan_does_not_grow_with_documents():
    counts = {n: 10**9 + 7919 * n for n in range(1, 2049)}
    slots = packing.plan(counts, 2048)
    assert len(slots.length) < 12 * 2048
    s, o = slots.place(np.array([2048, 5]), np.array([counts[2048] - 1, counts[5] - 1]))
    assert o[0] == 0 and 0 <= o[1] <= 2043
    assert slots.place(np.array([1]), np.array([0]))[0][0] >= 0


def test_word_ids_equal_whole_texts():
    import pyarrow as pa

    library, own = Tokenizer.from_file(PATH), WordTokenizer(PATH)
    assert own.by_word
    for _ in range(2):
        ids, bounds = own.encode(pa.array([t for _, t in documents()]))
        for i, (_, t) in enumerate(documents()):
            assert ids[bounds[i] : bounds[i + 1]].tolist() == library.encode(t or "", add_special_tokens=False).ids
    assert not WordTokenizer(public_tokenizers.path("byte_bpe_50k.json")).by_word
    sliced = pa.array(["x", "a b", None, "c"]).slice(1, 2)
    assert own.encode(sliced)[1].tolist() == [0, 2, 2]


@pytest.mark.parametrize("capacity", [2048, 100])
def test_pack(spark, capacity):
    rows = documents()
    docs = spark.createDataFrame([(d, t, "p", 7, None) for d, t in rows], SCHEMA).repartition(5)
    got = packing.pack(docs, PATH, capacity).collect()
    want = own_pieces(rows, capacity)
    name = lambda r: (r[0] is None, r)
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str), name
    n = check_places([(r.sequence_id, r.offset, r.length) for r in got], capacity)
    assert n == best_fit([w[3] for w in want], capacity)


def test_sequences_hold_the_ids(spark):
    rows = [(d, t) for d, t in documents() if d is not None and d != 3]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    library, parts = Tokenizer.from_file(PATH), defaultdict(dict)
    for r in packing.sequences(docs, PATH, 500).collect():
        assert len(r.ids) <= 500
        for p in r.pieces:
            parts[p.doc_id][p.piece] = r.ids[p.offset : p.offset + p.length]
    for d, t in rows:
        assert sum((parts[d][i] for i in range(len(parts[d]))), []) == library.encode(t or "", add_special_tokens=False).ids + [0]


def test_query(spark, tmp_path):
    rows = documents()
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = llm.op11_packing(spark, str(tmp_path))
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert dict(got.dtypes)["piece"] == "int"
    assert sorted([tuple(r)[:5] for r in got.collect()], key=str) == sorted(own_pieces(rows, 2048), key=str)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/none/documents.parquet")
    assert llm.op11_packing(spark, f"{tmp_path}/none").count() == 0

"""Unigram encoding against the public library's own Viterbi on the same scores, and against brute force."""

import random
import struct

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece

from textlab.llm import unigram

TEXTS = [
    "", " ", "   ", "a", "Hello  world", " lead and trail  ", "tabs\tand\nlines\r\n", "héllo wörld 日本語", "\U0001f600 smile\U0001f600\U0001f600",
    "x" * 3000, "word " * 500, "\u0000\u0001 control", "mixed ☃ snow",
]


@pytest.fixture(scope="module")
def model():
    return unigram.load(public_tokenizers.path("piece_bpe_32k.model"))


def field(number, wire, payload):
    def varint(x):
        out = b""
        while x > 127:
            out, x = out + bytes([x & 127 | 128]), x >> 7
        return out + bytes([x])
    return varint(number << 3 | wire) + (varint(len(payload)) + payload if wire == 2 else payload if wire == 5 else varint(payload))


def as_unigram_file(model, path):
    """The same pieces and log scores as a unigram model of the public library, written field by field."""
    source = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = b""
    for i in range(source.get_piece_size()):
        kind = 2 if source.is_unknown(i) else 3 if source.is_control(i) else 6 if source.is_byte(i) else 5 if source.is_unused(i) else 1
        out += field(1, 2, field(1, 2, source.id_to_piece(i).encode()) + field(2, 5, struct.pack("<f", model.score[i])) + field(3, 0, kind))
    out += field(2, 2, field(3, 0, 1) + field(4, 0, source.get_piece_size()) + field(35, 0, 1))
    out += field(3, 2, field(1, 2, b"identity") + field(3, 0, 1) + field(4, 0, 0) + field(5, 0, 1))
    path.write_bytes(out)
    return sentencepiece.SentencePieceProcessor(model_file=str(path))


def encode(model, texts):
    ids, bounds = unigram.Encoder(model).encode(pa.array(texts, pa.string()))
    return [ids[a:b] for a, b in zip(bounds, bounds[1:])], (ids, bounds)


def test_scores_equal_the_public_library(model, tmp_path, spark, sf):
    library = as_unigram_file(model, tmp_path / "u.model")
    texts = TEXTS + [r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").limit(60).collect()]
    own, _ = encode(model, texts)
    total = lambda ids: sum(model.unknown if i in set(model.byte_id) else model.score[i] for i in ids)
    for text, ids in zip(texts, own):
        theirs = library.encode(text)
        if list(ids) != theirs and not any(i in set(model.byte_id) for i in theirs):
            assert total(ids) == pytest.approx(total(theirs), abs=1e-3), text[:80]  # a tie


def test_round_trip(model):
    own, (ids, bounds) = encode(model, TEXTS)
    assert unigram.decode_bytes(model, ids, bounds) == [t.encode() for t in TEXTS]


def brute(pieces, score, byte_id, unknown, text):
    data = b" " + text.encode() if text else b""
    best = [(0.0, [])] + [None] * len(data)
    for i in range(len(data)):
        if best[i] is None:
            continue
        width = len(data[i:].decode("utf-8", "ignore")[:1].encode())
        ways = [(len(p), score[k], [k]) for k, p in pieces.items() if p and data.startswith(p, i)]
        if not any(n == width for n, _, _ in ways):
            ways.append((width, unknown, [byte_id[b] for b in data[i : i + width]]))
        for n, s, k in ways:
            if best[i + n] is None or best[i][0] + s > best[i + n][0]:
                best[i + n] = (best[i][0] + s, best[i][1] + k)
    return best[-1]


@pytest.mark.parametrize("across", [False, True])
def test_small_models_against_brute_force(across):
    rng = random.Random(5)
    byte_id = np.arange(256) + 40
    for trial in range(20):
        words = {"".join(rng.choice(" abé") for _ in range(rng.randint(1, 4))) for _ in range(25)}
        words = sorted(w for w in words if across or " " not in w.lstrip(" "))
        pieces = {i: w.encode() for i, w in enumerate(words)}
        score = np.array([-rng.random() * 9 for _ in range(296)])
        model = unigram.build(pieces, score, byte_id)
        texts = ["".join(rng.choice(" abéc日") for _ in range(rng.randint(0, 12))) for _ in range(40)]
        own, _ = encode(model, texts)
        for text, ids in zip(texts, own):
            best = brute(pieces, score, byte_id, model.unknown, text)
            decoded = b"".join(pieces.get(i, bytes([i - 40]) if i >= 40 else b"") for i in ids)
            assert decoded == (b" " + text.encode() if text else b"")
            if list(ids) != best[1]:  # a tie
                assert not any(i >= 40 for i in set(ids) ^ set(best[1]))
                assert sum(score[i] for i in ids if i < 40) == pytest.approx(sum(score[i] for i in best[1] if i < 40))


def test_frames(spark, model):
    rows = [(1, "Hello world", "x"), (2, None, None), (2, None, None), (3, "", "y"), (None, "a日" * 2000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = unigram.decode(unigram.encode(docs, model), model)
    assert sorted((r.doc_id or 0, r.decoded) for r in out.collect()) == sorted((d or 0, t or "") for d, t, _ in rows)
    assert unigram.encode(docs.limit(0), model).count() == 0
    with pytest.raises(Exception, match="not in the model"):
        unigram.decode(spark.createDataFrame([([99999],)], "ids array<int>"), model).collect()

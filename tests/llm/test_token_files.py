import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from textlab.llm import token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", None, " ", "   ", "x  ", "  a  b\n\n c d  　 e  ", " \n x y", "a\t b\r\n c", "é é 中 中 \xa0 z", "don't  won't 've 12 34",
    "<|endoftext|> a <|endoftext|>b", "same words same words " * 400, "lone​ marks … – “q”", "same words",
]


@pytest.mark.parametrize("chain", [1, 3, 256])
def test_ids_are_those_of_the_library(monkeypatch, chain):
    monkeypatch.setattr(token_files, "CHAIN", chain)
    tokenizer = token_files.Tokenizer(PATH)
    for _ in range(2):  # the second time from the cache
        ids, bounds = tokenizer.encode(pa.array(TEXTS))
        for i, text in enumerate(TEXTS):
            assert tokenizer.library.encode(text or "", add_special_tokens=False).ids == ids[bounds[i] : bounds[i + 1]].tolist()


def test_pieces_are_encoded_alone_where_bytes_do_not_tell_their_ends():
    tokenizer = token_files.Tokenizer(PATH)
    want = tokenizer.encode(pa.array(TEXTS))
    tokenizer.cache.forget()
    tokenizer.bytes_of[:] = 1
    got = tokenizer.encode(pa.array(TEXTS))
    assert all(np.array_equal(a, b) for a, b in zip(want, got))


def plain_pairs(symbols, last):
    counts = {}
    for i in range(len(symbols) - 1):
        if not last[i]:
            pair = (int(symbols[i]), int(symbols[i + 1]))
            counts[pair] = counts.get(pair, 0) + 1
    return counts


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 200, 2000])
@pytest.mark.parametrize("least", [2, 3, 32])
def test_a_grammar_gives_the_ids_back_and_leaves_no_frequent_pair(n, least):
    random = np.random.default_rng(n)
    ids, last = random.integers(0, 5, n), random.random(n) < 0.05
    if n:
        last[-1] = True
    symbols, ends, left, right = token_files.compress(ids.copy(), last.copy(), 10, least)
    lengths = token_files.rule_lengths(left, right, 10)
    assert np.array_equal(token_files.expand(symbols, left, right, lengths, 10), ids)
    sizes = np.where(symbols >= 10, lengths[np.maximum(symbols - 10, 0)] if len(lengths) else 1, 1)
    assert np.array_equal(np.cumsum(sizes)[ends] - 1, np.flatnonzero(last))
    assert max(plain_pairs(symbols, ends).values(), default=0) < least

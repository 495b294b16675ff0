"""Token ids by the ``tokenizers`` library for vocabularies that drop white space: every distinct word is encoded once."""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from textlab.llm.segments import spread
from textlab.llm.words import BYTE_CODES, mix, powers, text_bytes

CACHE_BYTES = 96 << 20    # of known words and their ids
CHAIN = 512               # words that the library gets as one text
BETWEEN = "\x01"


def word_lists(column: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The words between ASCII white space of all rows, coded, and the bounds of each row's words; null has none."""
    lists = pc.ascii_split_whitespace(column.cast(pa.large_string()).fill_null(""))
    coded, bounds = lists.values.dictionary_encode(), lists.offsets.to_numpy()
    blank = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    if blank < 0:
        return coded, bounds
    filled = coded.indices.to_numpy() != blank
    return coded.filter(pa.array(filled)), np.concatenate([[0], np.cumsum(filled)])[bounds]


class WordCache:
    """Ids of known words by two independent 64-bit hashes, sorted by the first; it starts anew beyond ``CACHE_BYTES``."""

    def __init__(self):
        self.forget()

    def forget(self) -> None:
        self.hash, self.check, self.row = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def rows(self, hashes: np.ndarray, checks: np.ndarray) -> np.ndarray:
        """Rows of words, -1 for those that are not known."""
        if not len(self.hash):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        return np.where((self.hash[at] == hashes) & (self.check[at] == checks), self.row[at], -1)

    def add(self, hashes: np.ndarray, checks: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Rows of new words; words whose first hash is already taken get ids but no entry."""
        first = len(self.bounds) - 1
        self.ids = np.concatenate([self.ids, ids])
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(counts)])
        order = np.argsort(hashes, kind="stable")
        order = order[np.diff(hashes[order], prepend=~hashes[order[:1]]) != 0]
        at = np.searchsorted(self.hash, hashes[order])
        if len(self.hash):
            free = self.hash[np.minimum(at, len(self.hash) - 1)] != hashes[order]
            order, at = order[free], at[free]
        for name, values in (("hash", hashes), ("check", checks), ("row", first + np.arange(len(hashes)))):
            setattr(self, name, np.insert(getattr(self, name), at, values[order]))
        return first + np.arange(len(hashes))

    def full(self) -> bool:
        return 24 * len(self.hash) + 4 * len(self.ids) + 8 * len(self.bounds) > CACHE_BYTES


def hashes_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit hashes of each word."""
    data, offsets = text_bytes(words)
    size = np.diff(offsets)
    if not len(data):
        return np.zeros(len(words), np.uint64), np.zeros(len(words), np.uint64)
    place = np.arange(len(data)) - np.repeat(offsets[:-1], size)
    start = np.minimum(offsets[:-1], len(data) - 1)
    filled = size > 0

    def sums(codes):
        return mix(np.where(filled, np.add.reduceat(codes * powers(int(size.max()))[place], start), np.uint64(0)) + size.astype(np.uint64))

    return sums(BYTE_CODES[data]), sums(mix(BYTE_CODES)[data])


class WordTokenizer:
    """Ids of texts. A tokenizer that drops white space gives a text the ids of its words one after another, which is
    tested on loading; any other gets whole texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library, self.cache = Tokenizer.from_file(path), WordCache()
        probe = ["It's", "a1", "(x)", BETWEEN, "É", "naïve"]
        apart = self._ids(probe)
        self.by_word = len(apart[3]) == 1 and self._ids([" ".join(probe)])[0] == sum(apart, []) == self._ids(["\n".join(probe) + "\t "])[0]
        self.between = apart[3][0] if self.by_word else None

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after another, and their number by word. ``CHAIN`` words make a text, with a word between
        them whose id no other byte has; words that hold it are texts of their own."""
        alone = [i for i, w in enumerate(words) if BETWEEN in w]
        if alone:
            found = self._ids(words)
            return np.array([i for ids in found for i in ids], np.int32), np.array([len(ids) for ids in found], np.int64)
        texts = [f" {BETWEEN} ".join([*words[i : i + CHAIN], ""]) for i in range(0, len(words), CHAIN)]
        ids = np.concatenate([np.zeros(0, np.int32), *(np.array(own, np.int32) for own in self._ids(texts))])
        ends = np.flatnonzero(ids == self.between)
        assert len(ends) == len(words)
        return ids[ids != self.between], np.diff(ends, prepend=-1) - 1

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, and bounds of each row's ids; null is empty."""
        if not self.by_word:
            found = self._ids(column.cast(pa.large_string()).fill_null("").to_pylist())
            return np.fromiter((i for ids in found for i in ids), np.int32), np.concatenate([[0], np.cumsum([len(i) for i in found], dtype=np.int64)])
        coded, bounds = word_lists(column)
        if self.cache.full():
            self.cache.forget()
        hashes, checks = hashes_of(coded.dictionary)
        rows = self.cache.rows(hashes, checks)
        new = np.flatnonzero(rows < 0)
        rows[new] = self.cache.add(hashes[new], checks[new], *self._each(coded.dictionary.take(pa.array(new)).to_pylist()))
        flat, sizes = spread(self.cache.ids, self.cache.bounds, rows[coded.indices.to_numpy()])
        return flat, np.concatenate([[0], np.cumsum(sizes)])[bounds]


@lru_cache(maxsize=1)
def word_tokenizer(path: str) -> WordTokenizer:
    """One for all tasks that a Python worker runs."""
    return WordTokenizer(path)

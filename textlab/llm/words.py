"""Words of Arrow text columns as numpy arrays: bounds, owners and 64-bit hashes, without a Python step per word."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20  # work arrays are a few dozen times this; a longer text makes a slice of its own
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Letters, digits and every byte of a character beyond ASCII, after lower-casing.
ALPHANUMERIC = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
#: All but space and the controls from tab to carriage return.
NOT_SPACE = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every input bit moves every output bit."""
    x = values.astype(np.uint64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> np.uint64(shift)
        x *= np.uint64(factor)
    return x ^ (x >> np.uint64(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * MULTIPLIER)


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), MULTIPLIER)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offsets of its rows; null is empty."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the text of each stays near ``limit`` bytes; rows stay whole and in order."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


@dataclass
class Words:
    data: np.ndarray      # bytes of the slice, lower-cased
    doc: np.ndarray       # row of each word
    start: np.ndarray     # first byte of each word
    end: np.ndarray       # after its last byte
    hash: np.ndarray      # 64-bit hash of each word
    prefixes: list        # for each asked length, hashes of the words' first bytes
    bounds: np.ndarray    # words of row i: bounds[i] to bounds[i + 1]
    offsets: np.ndarray   # bytes of row i

    def key(self, first: int, n: int) -> bytes:
        """``n`` words from ``first`` on, joined by one space."""
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.start[first : first + n], self.end[first : first + n]))

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of ``n`` words inside one row."""
        count = len(self.hash) - n + 1
        if count <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        mixed, total = mix(self.hash), np.zeros(count, np.uint64)
        for i in range(n):
            total = total * MULTIPLIER + mixed[i : i + count]
        inside = np.flatnonzero(self.doc[:count] == self.doc[n - 1 :])
        return inside, mix(total[inside] + np.uint64(n))


def words(column: pa.Array, alphabet: np.ndarray, prefixes: tuple[int, ...] = (), lower: bool = True) -> Words:
    """Maximal runs of ``alphabet`` bytes of every row, A-Z lower-cased."""
    raw, offsets = text_bytes(column)
    return words_of_bytes(LOWER[raw] if lower else raw, offsets, alphabet, prefixes)


def words_of_bytes(data: np.ndarray, offsets: np.ndarray, alphabet: np.ndarray, prefixes: tuple[int, ...] = ()) -> Words:
    inside = alphabet[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    filled = np.flatnonzero(np.diff(offsets))
    before[offsets[filled]] = False
    after[offsets[filled + 1] - 1] = False
    start, end = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    doc = np.searchsorted(offsets, start, "right") - 1
    bounds = np.searchsorted(start, offsets)
    if not len(start):
        empty = np.zeros(0, np.uint64)
        return Words(data, doc, start, end, empty, [empty for _ in prefixes], bounds, offsets)
    at = np.flatnonzero(inside)
    size = end - start
    first = np.cumsum(size) - size
    place = np.arange(len(at)) - np.repeat(first, size)
    codes = BYTE_CODES[data[at]] * powers(int(size.max()))[place]
    cut = [np.add.reduceat(np.where(place < n, codes, np.uint64(0)), first) for n in prefixes]
    return Words(data, doc, start, end, np.add.reduceat(codes, first), cut, bounds, offsets)

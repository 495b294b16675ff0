"""Encodings of text segments, kept by the hash of the segment while a task runs."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

CACHE_SEGMENTS = 400_000


class SegmentCache:
    """Encodes each distinct segment once; beyond ``limit`` segments, or ids eight times as many, it starts anew, so its memory is bounded."""

    def __init__(self, limit: int = CACHE_SEGMENTS):
        self.limit = limit
        self.forget()

    def forget(self):
        self.hash, self.first = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.ids, self.bounds = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def encode(self, code: np.ndarray, solve: Callable) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments in order, and their number by segment; ``solve`` encodes segments by position: ids and bounds."""
        distinct, first, place = np.unique(code, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.hash, distinct), max(len(self.hash) - 1, 0))
        new = np.flatnonzero(self.hash[at] != distinct) if len(self.hash) else np.arange(len(distinct))
        if len(new) and (len(self.hash) + len(new) > self.limit or len(self.ids) > 8 * self.limit):
            self.forget()
            new = np.arange(len(distinct))
        if len(new):
            ids, bounds = solve(first[new])
            hashes = np.concatenate([self.hash, distinct[new]])
            firsts = np.concatenate([self.first, len(self.bounds) - 1 + np.arange(len(new))])
            self.bounds = np.concatenate([self.bounds, bounds[1:] + len(self.ids)])
            self.ids = np.concatenate([self.ids, ids])
            order = np.argsort(hashes, kind="stable")  # merges two sorted runs
            self.hash, self.first = hashes[order], firsts[order]
        own = self.first[np.searchsorted(self.hash, distinct)][place] if len(distinct) else np.zeros(0, np.int64)
        return spread(self.ids, self.bounds, own)


def spread(ids: np.ndarray, bounds: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the given rows one after another, and the number of each."""
    counts = bounds[rows + 1] - bounds[rows]
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return ids[np.arange(total) + np.repeat(bounds[rows] - (ends - counts), counts)], counts

"""Runs of repeated words in documents: squares from a suffix automaton whose link tree is a link-cut tree of last occurrences."""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.word_ids import word_lists
from textlab.llm.words import MULTIPLIER, mix, slices

LEAST_LENGTH = 6
LEAST_EXPONENT = 4
COMPACT = 1 << 15         # automata of longer stretches hold their numbers in arrays of four bytes


class LastOccurrences:
    """A suffix automaton whose link tree keeps, along every path that was last recoloured together, the word it last ended at.

    States are numbered from 1, the root; 0 is none. A path of one colour is a splay tree ordered by depth, whose root
    has the colour. All numbers of a state take 32 bytes in the compact form, and a stretch of n words has at most 2n states;
    only states with several next words have a dictionary.
    """

    def __init__(self, word: list[int]):
        states = 2 * len(word) + 2
        numbers = (lambda: array("i", bytes(4 * states))) if len(word) > COMPACT else lambda: [0] * states
        self.length, self.link, self.own, self.to = numbers(), numbers(), numbers(), numbers()
        self.more: dict[int, dict[int, int]] = {}
        self.end = array("i", bytes(4 * len(word)))
        self._build(word)
        self.left, self.right, self.colour = numbers(), numbers(), numbers()
        self.above = self.link  # at first every state is a path of its own below its link

    def _build(self, word: list[int]) -> None:
        """States of all prefixes; ``own`` and ``to`` hold a state's first next word, ``more`` the others."""
        length, link, own, to, more = self.length, self.link, self.own, self.to, self.more
        last = count = 1
        for place, c in enumerate(word):
            c += 1
            count += 1
            new, p = count, last
            length[new] = length[last] + 1
            q = 0
            while p:
                if own[p] == c:
                    q = to[p]
                    break
                if not own[p]:
                    own[p], to[p] = c, new
                else:
                    others = more.get(p)
                    if others is None:
                        more[p] = {c: new}
                    elif c in others:
                        q = others[c]
                        break
                    else:
                        others[c] = new
                p = link[p]
            if not p:
                link[new] = 1
            elif length[q] == length[p] + 1:
                link[new] = q
            else:
                count += 1
                length[count], own[count], to[count], link[count] = length[p] + 1, own[q], to[q], link[q]
                if q in more:
                    more[count] = dict(more[q])
                link[q] = link[new] = count
                while p:
                    if own[p] == c:
                        if to[p] != q:
                            break
                        to[p] = count
                    else:
                        others = more.get(p)
                        if others is None or others.get(c) != q:
                            break
                        others[c] = count
                    p = link[p]
            last = new
            self.end[place] = new

    def _splay(self, x: int) -> None:
        """Make ``x`` the root of its path's tree, with the path's colour."""
        left, right, above, colour = self.left, self.right, self.above, self.colour
        y = above[x]
        if not y or (left[y] != x and right[y] != x):
            return
        while y and (left[y] == x or right[y] == x):
            z = above[y]
            inner = z and (left[z] == y or right[z] == y)
            turns = (y, x) if inner and (left[z] == y) == (left[y] == x) else (x, x)
            for v in turns if inner else (x,):
                u = above[v]
                w = above[u]
                if left[u] == v:
                    b = right[v]
                    left[u], right[v] = b, u
                else:
                    b = left[v]
                    right[u], left[v] = b, u
                if b:
                    above[b] = u
                if w:
                    if left[w] == u:
                        left[w] = v
                    elif right[w] == u:
                        right[w] = v
                above[u], above[v] = v, w
                colour[v] = colour[u]
            y = above[x]

    def append(self, place: int) -> list[tuple[int, int]]:
        """Recolour the path of the prefix that ends at ``place``; ``(place, period)`` of every primitive square that ends there.

        On a segment that last ended at j, the suffixes have lengths from that of the segment above it, exclusive, to that
        of its deepest state here. The suffix of length d = place - j is one of them exactly when it stands twice in a row and
        nowhere between, which is when it makes a square of primitive period d.
        """
        right, above, colour, length = self.right, self.above, self.colour, self.length
        found, x, below, now = [], self.end[place], 0, place + 1
        while x:
            self._splay(x)
            upper, old = above[x], colour[x]
            if old and length[upper] < now - old <= length[x]:
                found.append(now - old)
            cut = right[x]
            if cut:
                colour[cut] = old
            right[x] = below
            below, x = x, upper
        colour[below] = now
        return found


def _reach(word: np.ndarray, a: int, b: int, step: int) -> int:
    """How many words from ``a`` and from ``b`` on are equal one by one, forwards or backwards."""
    done, size = 0, 16
    while True:
        if step > 0:
            one, two = word[a + done : a + done + size], word[b + done : b + done + size]
            one = one[: len(two)]
        else:
            low = max(a - done - size + 1, 0)
            one = word[low : a - done + 1][::-1] if a - done >= 0 else word[:0]
            two = word[b - done - len(one) + 1 : b - done + 1][::-1]
        if not len(one):
            return done
        unequal = one != two
        if unequal.any():
            return done + int(unequal.argmax())
        done, size = done + len(one), size * 4


def maximal_runs(word: np.ndarray) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every maximal repetition with a length of at least two smallest periods."""
    _, codes = np.unique(word, return_inverse=True)
    tree, runs, reached = LastOccurrences(codes.tolist()), [], {}
    for place in range(len(codes)):
        for period in tree.append(place):
            if reached.get(period, -1) >= place:
                continue  # the run that holds this square is known
            start = place - 2 * period + 1
            start -= _reach(codes, start - 1, start + period - 1, -1)
            end = place + _reach(codes, place + 1 - period, place + 1, 1)
            reached[period] = end
            runs.append((start, end - start + 1, period))
    return runs


def stretches(codes: np.ndarray, bounds: np.ndarray, least_length: int, least_exponent: int) -> tuple[np.ndarray, np.ndarray]:
    """Stretches of words outside which no run of ``least_length`` words and ``least_exponent`` periods can reach.

    In such a run every two neighbouring words stand ``least_exponent - 1`` times, and every three as often or, with a
    period of one word, ``least_length - 2`` times. Where the next three words stand less often in the same stretch the
    text is cut, until nothing changes. Counts are kept by a hash and can only be too high, which cuts less.
    """
    least = min(least_exponent - 1, max(least_length, least_exponent) - 2)
    first, last = bounds[:-1].astype(np.int64), bounds[1:].astype(np.int64)
    long = last - first >= least_length
    first, last = first[long], last[long]
    covered, own = -1, codes.astype(np.uint64)
    while len(first) and int((last - first).sum()) != covered and least >= 2:
        covered = int((last - first).sum())
        starts = last - first - 2
        owner = np.repeat(np.arange(len(first)), starts)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(starts) - starts, starts) + first[owner]
        key = owner.astype(np.uint64)
        for i in range(3):
            key = key * MULTIPLIER + own[at + i]
        key = mix(key)
        cell = (key >> np.uint64(64 - max(12, int(4 * len(key)).bit_length()))).astype(np.int64)
        often = np.bincount(cell)[cell] >= least
        at, owner = at[often], owner[often]
        opens = np.ones(len(at), bool)
        opens[1:] = (np.diff(at) != 1) | (np.diff(owner) != 0)
        heads = np.flatnonzero(opens)
        first, last = at[heads], at[np.append(heads[1:], len(at)) - 1] + 3 if len(at) else at
        long = last - first >= least_length
        first, last = first[long], last[long]
    return first, last


def find_runs(docs: DataFrame, text: str = "text", least_length: int = LEAST_LENGTH, least_exponent: int = LEAST_EXPONENT) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` and ``collapsed``.

    Words are what white space from tab to carriage return and spaces leave. ``runs`` lists ``(start, length, period)``, by
    start and period, of every stretch of at least ``least_length`` words and ``least_exponent`` smallest periods that no
    neighbouring word extends; ``collapsed`` is the words outside all runs or in the first period of each that holds them, joined by
    one space. Null and empty texts have no words, no runs and an empty ``collapsed``. Each row stands for itself, so repeated ids
    and rows do too. Other columns stay, but those called like a result give way to it. A text is worked on whole; the part of it that
    can hold runs takes up to 100 bytes a word.
    """
    results = {"n_words": "long", "runs": "array<struct<start:long,length:long,period:long>>", "collapsed": "string"}
    kept = [f for f in docs.schema if f.name not in results]
    schema = docs.select(*[F.col(f"`{f.name}`") for f in kept], *[F.lit(None).cast(t).alias(n) for n, t in results.items()]).schema
    fields = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def run(batches):
        for batch in slices(batches, text):
            coded, bounds = word_lists(batch.column(text))
            codes = coded.indices.to_numpy().astype(np.int64)
            keep, found = np.ones(len(codes), bool), []
            for a, b in zip(*(x.tolist() for x in stretches(codes, bounds, least_length, least_exponent))):
                found += [(a + s, n, q) for s, n, q in maximal_runs(codes[a:b]) if n >= max(least_length, least_exponent * q)]
            table = np.array(sorted(set(found)), np.int64).reshape(-1, 3)
            for s, n, q in table.tolist():
                keep[s + q : s + n] = False
            doc = np.searchsorted(bounds, table[:, 0], "right") - 1
            lists = np.searchsorted(doc, np.arange(len(bounds)))
            starts = table[:, 0] - bounds[doc]
            runs = pa.StructArray.from_arrays([pa.array(starts), pa.array(table[:, 1]), pa.array(table[:, 2])], fields=list(fields))
            ends = np.concatenate([[0], np.cumsum(keep)])[bounds]
            words = coded.dictionary.take(pa.array(codes[keep]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [
                    pa.array(np.diff(bounds).astype(np.int64)), pa.ListArray.from_arrays(pa.array(lists.astype(np.int32)), runs),
                    pc.binary_join(pa.LargeListArray.from_arrays(pa.array(ends.astype(np.int64)), words), pa.scalar(" ", words.type)).cast(pa.string())],
                names=[f.name for f in kept] + list(results))

    return docs.select(*[F.col(f"`{f.name}`") for f in kept]).mapInArrow(run, schema)

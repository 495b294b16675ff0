"""Best-fit packing of documents into sequences of a fixed number of tokens, planned on the histogram of lengths alone."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.staging import staged
from textlab.llm.word_ids import word_tokenizer
from textlab.llm.words import slices

END_ID = 0
SLICE = 1 << 22           # bytes of text encoded at once: more of them share a word
RANK_BITS = 42            # slots are looked up by length and rank in one 64-bit number
PIECES = "part int, doc_id long, piece int, start long, length long, ids array<int>, ids_crc32 long, nth long"


@dataclass
class Slots:
    """Where documents go: those of ``length`` with ranks from ``first`` on fill sequences from ``sequence`` on, ``each`` to
    a sequence, the first of them at ``offset``. Rows are ordered by length and rank."""

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    each: np.ndarray
    offset: np.ndarray

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of documents by length and rank within it."""
        at = np.searchsorted((self.length << RANK_BITS) + self.first, (length << RANK_BITS) + rank, "right") - 1
        nth = rank - self.first[at]
        return self.sequence[at] + nth // self.each[at], self.offset[at] + nth % self.each[at] * length


def plan(counts: dict[int, int], capacity: int) -> Slots:
    """Best-fit decreasing over counts: ``counts`` is the number of documents of each length from 1 to ``capacity``.

    Open sequences are kept as ranges of equal remaining room. A length goes to the ranges of the least room that
    holds it, each sequence taking as many as fit, then to new sequences. A range at most halves its room whenever it
    takes something, and only the last range a length meets is split, so ranges and slots stay below a small multiple
    of ``capacity`` times its logarithm, whatever the counts.
    """
    rooms: list[int] = []                       # distinct remaining rooms, ascending
    open_: dict[int, list[tuple[int, int]]] = {}  # room -> ranges (first sequence, number)
    rows, made = [], 0

    def put(room: int, first: int, number: int) -> None:
        if room and number:
            if room not in open_:
                open_[room] = []
                insort(rooms, room)
            open_[room].append((first, number))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, number = open_[room].pop()
                if not open_[room]:
                    del open_[room], rooms[at]
            else:
                room, each = capacity, capacity // length
                first, number = made, -(-left // each)
                made += number
            each = room // length
            taken = min(left, each * number)
            rows.append((length, rank, first, each, capacity - room))
            full, rest = divmod(taken, each)
            put(room - each * length, first, full)
            if rest:
                put(room - rest * length, first + full, 1)
            put(room, first + full + bool(rest), number - full - bool(rest))
            left, rank = left - taken, rank + taken
    return Slots(*np.array(sorted(rows), np.int64).reshape(-1, 5).T)


def tokenized(docs: DataFrame, tokenizer_path: str, capacity: int) -> DataFrame:
    """One row per piece of ``docs`` (``doc_id``, ``text``): its ids and their CRC-32, its document's ids before it, and ``nth``,
    its number among the pieces of the same length that the same task made.

    Every document ends with id 0; a null text is that id alone. Documents of more than ``capacity`` ids are cut at its multiples.
    The tokenizer's path is opened by the executors.
    """
    from pyspark import TaskContext

    fields = {"part": pa.int32(), "piece": pa.int32(), "ids": pa.list_(pa.int32())}
    schema = pa.schema([(n, fields.get(n, pa.int64())) for n in (c.split()[0] for c in PIECES.split(", "))])

    def run(batches):
        tokenizer, part, met = word_tokenizer(tokenizer_path), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in slices(batches, limit=SLICE):
            flat, bounds = tokenizer.encode(batch.column("text"))
            size = np.diff(bounds) + 1
            ended = np.full(int(size.sum()), END_ID, np.int32)
            ended[np.arange(len(flat)) + np.repeat(np.arange(len(size)), size - 1)] = flat
            pieces = -(-size // capacity)
            row = np.repeat(np.arange(len(size)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(size[row] - start, capacity)
            ends = np.cumsum(length)
            raw = memoryview(ended.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip((ends - length).tolist(), ends.tolist())]
            order = np.argsort(length, kind="stable")
            ranked = length[order]
            nth = np.empty(len(row), np.int64)
            nth[order] = met[ranked] + np.arange(len(row)) - np.searchsorted(ranked, ranked)
            met += np.bincount(length, minlength=capacity + 1)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(row), part, np.int32)), batch.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start),
                pa.array(length), pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(ended)),
                pa.array(crc, pa.int64()), pa.array(nth)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, PIECES)


def place(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Written ``pieces`` of ``tokenized`` with ``sequence_id`` and ``offset``, without ``part`` and ``nth``.

    Their counts by length, at most ``capacity`` numbers, are all that the plan needs. A piece's rank within its length
    is its number in its task plus the pieces of that length in the tasks before, so neither a frequent length nor a
    repeated row meets in one task, and no document is sorted.
    """
    counts = staged(pieces.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    slots = plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}, capacity)
    before = staged(counts.withColumn("first", F.expr("sum(n) OVER (PARTITION BY length ORDER BY part) - n")).drop("n"), "first-ranks")
    kept = [f for f in pieces.schema if f.name not in ("part", "nth")]

    def run(batches):
        for batch in batches:
            length, first, nth = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "first", "nth"))
            sequence, offset = slots.place(length, first + nth)
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in kept] + [pa.array(sequence), pa.array(offset)], names=[f.name for f in kept] + ["sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", sequence_id long, offset long"
    return pieces.join(before, ["part", "length"]).mapInArrow(run, schema)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece of ``docs``, in as few sequences as best fit makes.

    Pieces are written once with their ids, which stay out of what the ranks need. Null and repeated ids are packed like
    others; an empty table gives no rows. Other columns of ``docs`` are left out.
    """
    return place(staged(tokenized(docs, tokenizer_path, capacity), "pieces").drop("ids"), capacity)


def sequences(docs: DataFrame, tokenizer_path: str, capacity: int = 2048) -> DataFrame:
    """``sequence_id``, ``ids``, and ``pieces``, the ``doc_id``, ``piece``, ``offset`` and ``length`` of what it holds, in order."""
    placed = place(staged(tokenized(docs, tokenizer_path, capacity), "pieces"), capacity)
    held = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "length", "ids")))  # at most ``capacity`` ids
    return placed.groupBy("sequence_id").agg(held.alias("held")).select(
        "sequence_id", F.flatten("held.ids").alias("ids"), F.transform("held", lambda h: F.struct(h["doc_id"], h["piece"], h["offset"], h["length"])).alias("pieces"))

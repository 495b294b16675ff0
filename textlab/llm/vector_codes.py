"""Product quantisation with integer codebooks: nearest entries from slices of sorted coordinates and intersected bit masks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.llm.staging import staged

SCALE = 256
LIMIT = 1 << 28           # scaled components are held within this, so that distances and sums fit 64 bits
MAX_ENTRIES = 64          # one bit each in a mask
COMPONENTS = 1 << 20      # components that a task works on at once


class Slices:
    """The codebook of one part position, as sorted coordinates whose prefixes carry the set of their entries as a bit mask."""

    def __init__(self, entries: np.ndarray):
        self.entries = np.asarray(entries, np.int64)
        count, dims = self.entries.shape
        if count > MAX_ENTRIES:
            raise ValueError(f"{count} entries do not fit a mask of {MAX_ENTRIES} bits")
        self.order = np.argsort(self.entries, axis=0, kind="stable")
        self.sorted = [np.ascontiguousarray(np.take_along_axis(self.entries, self.order, 0)[:, d]) for d in range(dims)]
        bits = np.uint64(1) << np.arange(count, dtype=np.uint64)
        self.prefix = [np.concatenate([np.zeros(1, np.uint64), np.bitwise_or.accumulate(bits[self.order[:, d]])]) for d in range(dims)]

    def distance(self, points: np.ndarray, entry: np.ndarray) -> np.ndarray:
        return ((points - self.entries[entry]) ** 2).sum(axis=1)

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of each point; ties go to the lower index.

        The entries next to a point in any single coordinate give an initial radius that holds at least one of them, so
        no entry outside the slices of that radius can be nearest, and every entry inside all of them is compared.
        """
        reach = np.full(len(points), np.iinfo(np.int64).max)
        for d, line in enumerate(self.sorted):
            above = np.searchsorted(line, points[:, d])
            for at in (np.maximum(above - 1, 0), np.minimum(above, len(line) - 1)):
                reach = np.minimum(reach, self.distance(points, self.order[at, d]))
        radius = np.sqrt(reach.astype(np.float64)).astype(np.int64) + 1
        left = np.full(len(points), ~np.uint64(0))
        for d, line in enumerate(self.sorted):
            low = np.searchsorted(line, points[:, d] - radius, "left")
            high = np.searchsorted(line, points[:, d] + radius, "right")
            left &= self.prefix[d][high] ^ self.prefix[d][low]
        best, found = np.full(len(points), np.iinfo(np.int64).max), np.zeros(len(points), np.int64)
        rows = np.arange(len(points))
        while len(rows):  # the lowest entry of every mask that is not empty, in ascending order
            masks = left[rows]
            lowest = masks & (~masks + np.uint64(1))
            entry = np.log2(lowest.astype(np.float64)).astype(np.int64)
            distance = self.distance(points[rows], entry)
            nearer = distance < best[rows]
            best[rows[nearer]], found[rows[nearer]] = distance[nearer], entry[nearer]
            left[rows] = masks ^ lowest
            rows = rows[left[rows] != 0]
        return found, best


def finite(vector: str) -> Column:
    """True for a vector with entries, none of them null, NaN or infinite."""
    whole = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce(F.col(vector).isNotNull() & (F.size(vector) > 0) & whole, F.lit(False))


def scaled(column: pa.Array, dim: int) -> np.ndarray:
    """``floor(256 x)`` of vectors of ``dim`` components."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths != dim).any():
        raise ValueError(f"a vector does not have {dim} components")
    values = np.asarray(column.flatten(), np.float64).reshape(len(column), dim)
    return np.clip(np.floor(values * SCALE), -LIMIT, LIMIT).astype(np.int64)


def _pieces(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    step = max(1, COMPONENTS // dim)
    for batch in batches:
        for i in range(0, batch.num_rows, step):
            piece = batch.slice(i, step)
            yield piece, scaled(piece.column("_vector"), dim)


def train_codebooks(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", parts: int = 16, entries: int = MAX_ENTRIES, rounds: int = 2,
) -> np.ndarray:
    """Codebooks of shape ``(parts, entries, components of a part)`` by k-means over all vectors.

    They start as the parts of the rows with the smallest keys (nulls last, repeated keys by vector; fewer rows, fewer
    entries). A round sends each part to its nearest entry, and an entry becomes the floor of its parts' mean; an entry
    without parts stays. A task sends one row per part and entry, so shuffles grow with tasks, not with vectors.
    Vectors that are null or empty or hold null or non-finite components are left out; no vectors give no entries.
    Other lengths than that of the first vector, or one that ``parts`` does not divide, are an error.
    """
    rows = vectors.where(finite(vector)).select(F.col(key).alias("_key"), F.col(vector).cast("array<double>").alias("_vector"))
    first = rows.orderBy(F.asc_nulls_last("_key"), "_vector").limit(entries).select("_vector").toArrow()["_vector"].combine_chunks()
    if not len(first):
        return np.zeros((parts, 0, 0), np.int64)
    dim = len(first[0])
    if dim % parts:
        raise ValueError(f"{parts} equal parts do not make {dim} components")
    width = dim // parts
    books = scaled(first, dim).reshape(len(first), parts, width).transpose(1, 0, 2)
    for _ in range(rounds):
        books = _moved(rows.select("_vector"), books)
    return books


def _moved(rows: DataFrame, books: np.ndarray) -> np.ndarray:
    parts, entries, width = books.shape

    def run(batches):
        slices = [Slices(b) for b in books]
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, width), np.int64)
        for _, points in _pieces(batches, parts * width):
            for p in range(parts):
                own = points[:, p * width : (p + 1) * width]
                found, _ = slices[p].nearest(own)
                counts[p] += np.bincount(found, minlength=entries)
                np.add.at(sums[p], found, own)
        used = np.flatnonzero(counts.ravel())
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(counts.ravel()[used])] + [pa.array(sums.reshape(-1, width)[used, d]) for d in range(width)],
            names=["slot", "n"] + [f"s{d}" for d in range(width)])

    sent = rows.mapInArrow(run, ", ".join(f"{c} long" for c in ["slot", "n"] + [f"s{d}" for d in range(width)]))
    total = sent.groupBy("slot").agg(*[F.sum(c).alias(c) for c in sent.columns[1:]]).toArrow()  # at most parts * entries rows
    moved = books.copy().reshape(-1, width)
    slot, n = total["slot"].to_numpy(), total["n"].to_numpy()
    for d in range(width):
        moved[slot, d] = total[f"s{d}"].to_numpy() // n
    return moved.reshape(books.shape)


def encode(vectors: DataFrame, books: np.ndarray, vector: str = "embedding") -> DataFrame:
    """The rows of vectors that can be coded, with ``code`` (binary, one entry index per part) and ``error`` (squared distance).

    Vectors that are null or empty or hold null or non-finite components are left out. Other columns stay, but one that
    is called ``code`` or ``error`` gives way to the result.
    """
    parts, entries, width = books.shape
    kept = [c for c in vectors.columns if c not in ("code", "error")]
    own = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row")
    schema = vectors.select(own).schema.add("code", "binary").add("error", "long")

    def run(batches):
        slices = [Slices(b) for b in books]
        for piece, points in _pieces(batches, max(parts * width, 1)):
            codes, error = np.zeros((len(points), parts), np.uint8), np.zeros(len(points), np.int64)
            for p in range(parts):
                codes[:, p], distance = slices[p].nearest(points[:, p * width : (p + 1) * width])
                error += distance
            flat = pa.Array.from_buffers(pa.binary(parts), len(points), [None, pa.py_buffer(codes.tobytes())])
            yield pa.RecordBatch.from_arrays([piece.column("_row"), flat.cast(pa.binary()), pa.array(error)], names=["_row", "code", "error"])

    rows = vectors.where(finite(vector) if entries else F.lit(False)).select(
        own, F.col(vector).cast("array<double>").alias("_vector"))
    coded = rows.mapInArrow(run, schema)
    return coded.select(*[F.col("_row").getField(c).alias(c) for c in kept], "code", "error")


def decode(coded: DataFrame, books: np.ndarray, into: str = "decoded") -> DataFrame:
    """``coded`` with the vector that each ``code`` stands for, as array<double>; null stays null."""
    parts, _, width = books.shape
    if not books.size:
        return coded.withColumn(into, F.lit(None).cast("array<double>"))
    lists = F.array(*[F.array(*[F.array(*[F.lit(int(x) / SCALE) for x in entry]) for entry in book]) for book in books])
    at = [F.conv(F.hex(F.substring("code", p + 1, 1)), 16, 10).cast("int") for p in range(parts)]
    return coded.withColumn(into, F.when(F.col("code").isNotNull(), F.flatten(F.array(*[lists[p][at[p]] for p in range(parts)]))))


def with_label_error(coded: DataFrame, label: str = "label") -> DataFrame:
    """``coded`` with ``label_error``, the summed error of all rows of its label; nulls are one label.

    Rows are written once; sums of labels are small rows whose measured size lets the planner choose the join.
    """
    rows = staged(coded, "codes")
    sums = staged(rows.groupBy(F.col(f"`{label}`").alias("_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    return rows.drop("label_error").join(sums, F.col(f"`{label}`").eqNullSafe(F.col("_label"))).drop("_label")


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, as decimal integers joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()

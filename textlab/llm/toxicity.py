"""Toxicity scores from a factorization machine over hashed terms."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.llm.words import ALPHANUMERIC, mix, slices, words

BUCKETS = 1 << 18
FACTORS = 8
STEMS = (4, 5, 6)         # bytes of the word beginnings that are terms beside whole words
SAMPLE = 16_384           # most labelled documents that a model is fitted on
LEAST_DOCS = 3            # terms of fewer sampled documents get no weight
EPOCHS, BATCH, RATE, PENALTY = 12, 256, 0.02, 2e-4
DAMPING = 0.5             # terms count by the number of a document's terms to minus half this power
SEED = 11
PIECE = 1 << 20           # terms that are counted at once


def terms(part: pa.RecordBatch, active: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every distinct term of a slice, by row; ``active`` leaves out buckets without weight.

    Terms are words (runs of letters, digits and non-ASCII characters, A-Z lower-cased) and their beginnings.
    """
    found = words(part.column("text"), ALPHANUMERIC, STEMS)
    hashes = [found.hash] + found.prefixes
    buckets = np.concatenate([mix(h + np.uint64(i)) % np.uint64(BUCKETS) for i, h in enumerate(hashes)]).astype(np.int64)
    doc = np.tile(found.doc, len(hashes))
    if active is not None:
        keep = active[buckets]
        doc, buckets = doc[keep], buckets[keep]
    pairs = np.unique(doc * BUCKETS + buckets)
    return pairs // BUCKETS, pairs % BUCKETS


def _forward(model: dict, bounds: np.ndarray, bucket: np.ndarray):
    """Raw scores of rows of terms, and the sums that the gradient needs."""
    rows = len(bounds) - 1
    scale = 1 / np.sqrt(np.maximum(np.diff(bounds), 1)).astype(np.float32) ** model["damping"]
    linear, sums, squares = np.zeros(rows, np.float32), np.zeros((rows, FACTORS), np.float32), np.zeros((rows, FACTORS), np.float32)
    filled = np.flatnonzero(np.diff(bounds))
    if len(filled):
        v = model["v"][bucket]
        linear[filled] = np.add.reduceat(model["w"][bucket], bounds[filled])
        sums[filled] = np.add.reduceat(v, bounds[filled])
        squares[filled] = np.add.reduceat(v * v, bounds[filled])
    pair = 0.5 * (sums**2 - squares).sum(axis=1)
    return model["bias"] + linear * scale + pair * scale**2, scale, sums


def _sigmoid(raw: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(raw, -60, 60)))


def fit(bounds: np.ndarray, bucket: np.ndarray, label: np.ndarray, damping: float = DAMPING) -> dict:
    """Logistic loss, Adam on mini-batches; rows of terms as bounds and buckets. Fixed seed, no other randomness.

    Terms are not screened by what they tell alone: some tell something only together.
    """
    rng = np.random.default_rng(SEED)
    met = np.zeros(BUCKETS, np.int64)
    for i in range(0, len(bucket), PIECE):  # all terms of the sample are held once, in 32 bits
        met += np.bincount(bucket[i : i + PIECE], minlength=BUCKETS)
    active = met >= LEAST_DOCS
    place = np.full(BUCKETS, -1, np.int32)
    used = np.flatnonzero(active)
    place[used] = np.arange(len(used))
    keep = active[bucket]
    at = place[bucket[keep]]
    bounds = np.concatenate([np.zeros(1, np.int32), np.cumsum(keep, dtype=np.int32)])[bounds].astype(np.int64)
    del keep
    rate = float(np.clip(label.mean() if len(label) else 0.0, 1e-3, 1 - 1e-3))
    model = {"bias": np.log(rate / (1 - rate)), "w": np.zeros(len(used), np.float32),
             "v": rng.normal(0, 0.02, (len(used), FACTORS)).astype(np.float32), "damping": damping}
    moments = {k: (np.zeros_like(model[k]), np.zeros_like(model[k])) for k in ("w", "v")}
    step = 0
    for _ in range(EPOCHS if len(used) and 0 < label.sum() < len(label) else 0):
        order = rng.permutation(len(label))
        for start in range(0, len(order), BATCH):
            rows = order[start : start + BATCH]
            sizes = bounds[rows + 1] - bounds[rows]
            part = np.concatenate([[0], np.cumsum(sizes)])
            term = at[np.repeat(bounds[rows] - part[:-1], sizes) + np.arange(part[-1])]
            raw, scale, sums = _forward(model, part, term)
            error = (_sigmoid(raw) - label[rows]) / len(rows)
            owner = np.repeat(np.arange(len(rows)), sizes)
            model["bias"] -= RATE * float(error.sum())
            touched, inverse = np.unique(term, return_inverse=True)
            w = np.bincount(inverse, (error * scale)[owner], len(touched))
            v, pull = np.empty((len(touched), FACTORS)), (error * scale**2)[owner]
            for f in range(FACTORS):
                v[:, f] = np.bincount(inverse, pull * (sums[owner, f] - model["v"][term, f]), len(touched))
            step += 1
            for name, gradient in (("w", w), ("v", v)):
                gradient = gradient + PENALTY * model[name][touched]
                first, second = moments[name]
                first[touched] = 0.9 * first[touched] + 0.1 * gradient
                second[touched] = 0.999 * second[touched] + 0.001 * gradient**2
                model[name][touched] -= RATE * (first[touched] / (1 - 0.9**step)) / (np.sqrt(second[touched] / (1 - 0.999**step)) + 1e-8)
    w, v = np.zeros(BUCKETS, np.float32), np.zeros((BUCKETS, FACTORS), np.float32)
    w[used], v[used] = model["w"], model["v"]
    return {"bias": float(model["bias"]), "w": w, "v": v, "damping": damping, "active": active}


def score(model: dict, part: pa.RecordBatch) -> np.ndarray:
    doc, bucket = terms(part, model["active"])
    raw, _, _ = _forward(model, np.searchsorted(doc, np.arange(part.num_rows + 1)), bucket)
    return _sigmoid(raw.astype(np.float64))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """A model fitted on at most ``sample`` labelled documents, those with the smallest hashed ids.

    ``labels`` has ``doc_id`` and ``toxic``; rows with a null in either are left out, of repeated ids the larger label
    holds. The sample of labels is bounded by ``sample`` and so broadcast to the documents; terms of the sample meet
    in one task, which fits the model and hands back one row of fixed size. Without labels of both kinds every
    score is the share of toxic labels, or near 0 without any.
    """
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("double")).alias("label"))
    place = F.xxhash64(F.col("doc_id").cast("string"), F.lit(SEED))
    # About the right share is cut off by hash first, so that no task has to order many more rows than it keeps.
    share = min(1.0, 1.5 * sample / max(known.count(), 1))
    chosen = known.where(F.pmod(place, F.lit(1 << 30)) < int(share * (1 << 30))).orderBy(place).limit(sample)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").select("text", "label")

    def extract(batches):
        for part in slices(batches):
            doc, bucket = terms(part)
            bounds = np.searchsorted(doc, np.arange(part.num_rows + 1))
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(bucket, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(part.num_rows, np.int64)), part.column("label"), lists], names=["one", "label", "terms"])

    def learn(table):
        lists = table.column("terms").combine_chunks()
        lists = lists if isinstance(lists, pa.ListArray) else lists.chunk(0)
        order = np.lexsort([lists.value_lengths().to_numpy(), table.column("label").to_numpy()])  # the same whatever the tasks
        lists = lists.take(pa.array(order))
        model = fit(np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]), lists.flatten().to_numpy(),
                    table.column("label").to_numpy()[order])
        used = np.flatnonzero(model["active"])
        parts = (used.astype("<i4"), model["w"][used].astype("<f4"), model["v"][used].astype("<f4"))
        return pa.table([pa.array([model["bias"]]), *(pa.array([x.tobytes()], pa.binary()) for x in parts)], names=["bias", "bucket", "w", "v"])

    # Copies of a sampled id bring rows of their own; the bound holds for them too.
    rows = texts.mapInArrow(extract, "one long, label double, terms array<int>").orderBy(F.xxhash64("terms", "label")).limit(sample)
    found = rows.groupBy("one").applyInArrow(learn, "bias double, bucket binary, w binary, v binary").collect()
    model = {"bias": -6.0, "w": np.zeros(BUCKETS, np.float32), "v": np.zeros((BUCKETS, FACTORS), np.float32), "damping": DAMPING,
             "active": np.zeros(BUCKETS, bool)}
    for row in found:
        used = np.frombuffer(row["bucket"], "<i4")
        model["bias"], model["active"][used], model["w"][used] = row["bias"], True, np.frombuffer(row["w"], "<f4")
        model["v"][used] = np.frombuffer(row["v"], "<f4").reshape(-1, FACTORS)
    return model


def score_toxicity(docs: DataFrame, model: dict) -> DataFrame:
    """Every row of ``docs`` with ``score`` between 0 and 1 from its whole text.

    Null and empty texts get the score of the model's bias. Repeated rows score alike. A column named ``score`` is
    replaced, all others stay. The model has a fixed size and is broadcast.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("score").withColumn("text", F.col("text").cast("string"))

    def rate(batches):
        for part in slices(batches):
            yield part.append_column("score", pa.array(score(shipped.value, part), pa.float64()))

    return docs.mapInArrow(rate, docs.withColumn("score", F.lit(0.0)).schema)


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5))

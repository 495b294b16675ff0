"""Benchmark decontamination: documents scanned against a set of benchmark n-grams."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.staging import set_aside, staged
from textlab.llm.words import ALPHANUMERIC, slices, words

N = 10
#: Largest set of windows, in bytes of their words and item ids, that is broadcast to the scan.
BROADCAST_BYTES = 64 << 20
HITS = {"n_words": "long", "n_hit": "long", "n_items": "long", "items": "array<string>", "spans": "array<struct<start:long,end:long>>"}


def benchmark_windows(benchmark: DataFrame, n: int = N) -> DataFrame:
    """``hash, n, window, items``: the distinct normalised windows of all items, each with its items' ids.

    An item of fewer than ``n`` words is one window of all its words; an item without words or with null text has none.
    Windows of items with a null id are kept and add no id.
    """

    def cut(batches):
        for part in slices(batches):
            found, ids = words(part.column("text"), ALPHANUMERIC), part.column("item_id").to_pylist()
            rows = []
            for size in range(1, n + 1):
                first, code = found.windows(size)
                for i, h in zip(first, code):
                    doc = found.doc[i]
                    length = found.bounds[doc + 1] - found.bounds[doc]
                    if size == n or length == size:
                        rows.append((int(h.astype(np.int64)), size, found.key(i, size), ids[doc]))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(
                zip(*rows) if rows else [[]] * 4, (pa.int64(), pa.int64(), pa.binary(), pa.string()))], names=["hash", "n", "window", "item"])

    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    cuts = items.mapInArrow(cut, "hash long, n long, window binary, item string")
    return cuts.groupBy("hash", "n", "window").agg(F.collect_set("item").alias("items"))


def _report(found, doc, known) -> dict:
    """What one document's candidate windows come to; ``known``: (first word, size, items) verified."""
    start, end = found.bounds[doc], found.bounds[doc + 1]
    hit, items = np.zeros(end - start, bool), set()
    for first, size, names in known:
        hit[first - start : first - start + size] = True
        items.update(names)
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    origin = found.offsets[doc]
    spans = [{"start": int(found.start[start + a] - origin), "end": int(found.end[start + b - 1] - origin)} for a, b in zip(edge[::2], edge[1::2])]
    return {"n_words": int(end - start), "n_hit": int(hit.sum()), "n_items": len(items), "items": sorted(items), "spans": spans}


def find_contamination(docs: DataFrame, benchmark: DataFrame, n: int = N, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Every row of ``docs`` with ``n_words, n_hit, n_items, items, spans`` (byte spans of the runs of hit words).

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A window's 64-bit hash finds
    candidates; its words decide. Null and empty texts have no words. Columns named like a result are replaced,
    all others stay; repeated rows are judged each. An empty benchmark hits nothing. Windows of an item with a null id
    hit words, but add nothing to ``n_items`` and ``items``.

    The windows are broadcast when their size, counted first, is at most ``broadcast_bytes``; a larger benchmark
    is joined with the documents' windows by hash instead, which shuffles hashes and rows of the window table.
    """
    windows = staged(benchmark_windows(benchmark, n), "windows")
    size = windows.agg(F.sum(F.length("window") + 64 + 24 * F.size("items"))).first()[0] or 0
    docs = docs.drop(*HITS).withColumn("text", F.col("text").cast("string"))
    return (_scan if size <= broadcast_bytes else _join)(docs, windows, n)


def _output(docs: DataFrame):
    out = docs
    for name, kind in HITS.items():
        out = out.withColumn(name, F.lit(None).cast(kind))
    return out.schema


REPORT = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items", pa.list_(pa.string())),
                    ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def _with_reports(part: pa.RecordBatch, reports: list[dict]) -> pa.RecordBatch:
    added = pa.array(reports, REPORT).flatten()
    return pa.RecordBatch.from_arrays([*part.columns, *added], names=[*part.schema.names, *[f.name for f in REPORT]])


def _scan(docs: DataFrame, windows: DataFrame, n: int) -> DataFrame:
    known: dict = defaultdict(dict)
    for row in windows.toLocalIterator():
        known[row["n"]].setdefault(row["hash"], []).append((bytes(row["window"]), row["items"]))
    tables = {size: (np.sort(np.array(list(by), np.int64).astype(np.uint64)), by) for size, by in known.items()}
    shipped = docs.sparkSession.sparkContext.broadcast(tables)

    def scan(batches):
        for part in slices(batches):
            found = words(part.column("text"), ALPHANUMERIC)
            hits = defaultdict(list)
            for size, (hashes, by) in shipped.value.items():
                first, code = found.windows(size)
                at = np.minimum(np.searchsorted(hashes, code), len(hashes) - 1)
                for i in np.flatnonzero(hashes[at] == code):
                    key = found.key(first[i], size)
                    hits[found.doc[first[i]]] += [(first[i], size, items) for window, items in by[int(code[i].astype(np.int64))] if window == key]
            yield _with_reports(part, [_report(found, d, hits.get(d, ())) for d in range(part.num_rows)])

    return docs.mapInArrow(scan, _output(docs))


def _join(docs: DataFrame, windows: DataFrame, n: int) -> DataFrame:
    sizes = [r["n"] for r in windows.select("n").distinct().collect()]  # at most n values

    def cut(batches):
        for part in slices(batches, limit=1 << 18):
            found, keys = words(part.column("text"), ALPHANUMERIC), part.column("content").to_numpy(zero_copy_only=False)
            for size in sizes:
                first, code = found.windows(size)
                doc = found.doc[first]
                yield pa.RecordBatch.from_arrays([pa.array(code.astype(np.int64)), pa.array(np.full(len(first), size)), pa.array(keys[doc], pa.string()),
                                                  pa.array(first - found.bounds[doc])], names=["hash", "n", "content", "first"])

    def judge(batches):
        for part in slices(batches):
            found, rows = words(part.column("text"), ALPHANUMERIC), part.column("candidates").to_pylist()
            reports = []
            for doc, candidates in enumerate(rows):
                base = found.bounds[doc]
                hits = [(base + c["first"], c["n"], c["items"]) for c in candidates or () if found.key(base + c["first"], c["n"]) == c["window"]]
                reports.append(_report(found, doc, hits))
            yield _with_reports(part.drop_columns(["content", "candidates"]), reports)

    aside, columns = set_aside(docs, ("content", "candidates"))
    keyed = aside.withColumn("content", F.sha2("text", 256))
    texts = keyed.select("content", "text").where("text is not null").dropDuplicates(["content"])
    cuts = texts.mapInArrow(cut, "hash long, n long, content string, first long")
    candidates = cuts.join(windows, ["hash", "n"]).groupBy("content").agg(F.collect_list(F.struct("first", "n", "window", "items")).alias("candidates"))
    found = keyed.join(staged(candidates, "candidates"), "content", "left").select(*keyed.columns, "candidates").mapInArrow(judge, _output(aside))
    return found.select(*columns, *HITS)


def decontaminate(docs: DataFrame, benchmark: DataFrame, action: str = "drop", n: int = N) -> DataFrame:
    """``docs`` without contaminated documents (``drop``) or without their hit spans (``spans``); columns stay as they were."""
    if action not in ("drop", "spans"):
        raise ValueError("action is drop or spans")
    aside, columns = set_aside(docs, HITS)
    found = find_contamination(aside, benchmark, n)
    if action == "drop":
        return found.where("n_hit = 0").select(*columns)

    def cut(batches):
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("_cut").to_pylist()):
                if spans:
                    raw = text.encode()
                    bounds = [0, *[x for s in spans for x in (s["start"], s["end"])], len(raw)]
                    text = b"".join(raw[a:b] for a, b in zip(bounds[::2], bounds[1::2])).decode()
                texts.append(text)
            place = batch.schema.get_field_index("text")
            out = batch.set_column(place, "text", pa.array(texts, pa.string()))
            yield out.select([c for c in out.schema.names if c != "_cut"])

    kept = found.select(*columns, F.col("spans").alias("_cut"))
    return kept.mapInArrow(cut, docs.withColumn("text", F.col("text").cast("string")).schema)


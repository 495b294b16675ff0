"""A stored index for approximate search: inverted lists around centroids, with product-quantised residuals.

Jégou, Douze, Schmid: Product Quantization for Nearest Neighbor Search (PAMI 2011).
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, sqrt

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlab.functions import vector as vx
from textlab.operators.sizing import small_side

MAX_LISTS = 16_384          # centroids are broadcast: 8 MB at 64 components
SAMPLE_ROWS = 65_536        # rows the centroids and codebooks are fitted on, whatever the table holds
ENTRIES = 256               # of a codebook, one byte in a code
ROUNDS = 10
PART_ROWS = 200_000         # rows of one list that a task scans
QUERY_BYTES = 8 << 20       # query vectors that meet a part of a list at once
SCORES = 4_000_000          # scores a task holds at once
PROBES = 0.6                # share of the lists that a query reads codes of
SHORTLIST = 12              # rows of a query that are scored exactly, times k


def k_means(points: np.ndarray, k: int, seed: int, rounds: int = ROUNDS) -> np.ndarray:
    """Centroids of a bounded sample; a centroid without points stays where it is."""
    rng = np.random.default_rng(seed)
    distinct = np.unique(points, axis=0)
    centres = distinct[rng.permutation(len(distinct))[:k]].copy()
    for _ in range(rounds):
        own = nearest(points, centres)
        counts = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The closest centre of each point, in blocks of bounded size."""
    half, step, out = (centres**2).sum(1) / 2, max(1, SCORES // max(len(centres), 1)), np.zeros(len(points), np.int64)
    for i in range(0, len(points), step):
        out[i : i + step] = (points[i : i + step] @ centres.T - half).argmax(1)
    return out


class Coder:
    """Fitted centroids ``(lists, dim)`` and residual codebooks ``(parts, entries, dim / parts)``."""

    def __init__(self, centroids: np.ndarray, books: np.ndarray):
        self.centroids, self.books = centroids, books
        self.parts, _, self.width = books.shape
        self.dim = centroids.shape[1]

    def encode(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """List and code of each vector."""
        own = nearest(vectors, self.centroids)
        rest = vectors - self.centroids[own]
        codes = [nearest(rest[:, p * self.width : (p + 1) * self.width], self.books[p]) for p in range(self.parts)]
        return own, np.stack(codes, 1).astype(np.uint8)

    def probes(self, queries: np.ndarray, count: int) -> np.ndarray:
        """The ``count`` closest lists of each query."""
        return np.argsort((self.centroids**2).sum(1) / 2 - queries @ self.centroids.T, axis=1, kind="stable")[:, :count]

    def scores(self, queries: np.ndarray, own: int, codes: np.ndarray) -> np.ndarray:
        """Dot products of queries with the vectors that codes of list ``own`` stand for."""
        total = np.repeat((queries @ self.centroids[own])[:, None], len(codes), 1)
        for p in range(self.parts):
            total += (queries[:, p * self.width : (p + 1) * self.width] @ self.books[p].T)[:, codes[:, p]]
        return total


def _matrix(column, dim: int) -> np.ndarray:
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths != dim).any():
        raise ValueError(f"a vector does not have {dim} entries")
    return np.asarray(column.flatten(), np.float64).reshape(len(column), dim)


def routed(batches, coder: Coder, probes: int, at_once: int = SCORES):
    """Arrow batches of queries ``_q``, ``_v`` with the closest lists of each in ``_lists``; about ``at_once`` distances are held."""
    import pyarrow as pa

    step = max(1, at_once // len(coder.centroids))
    for batch in batches:
        for i in range(0, batch.num_rows, step):
            part = batch.slice(i, step)
            lists = coder.probes(_matrix(part.column("_v"), coder.dim), probes).astype(np.int32)
            bounds = pa.array(np.arange(len(lists) + 1, dtype=np.int32) * lists.shape[1])
            yield pa.RecordBatch.from_arrays(
                [part.column("_q"), part.column("_v"), pa.ListArray.from_arrays(bounds, pa.array(lists.ravel()))], names=["_q", "_v", "_lists"])


def fit(table: DataFrame, vector: str, lists: int | None, parts: int | None, seed: int) -> Coder:
    """Fit on ``SAMPLE_ROWS`` rows, those with the smallest hashes of their vectors. Codebooks of the parts are fitted side by side."""
    known = table.where(F.col(vector).isNotNull())
    rows = known.count()
    sample = known.select(F.col(vector).cast("array<double>").alias("v")).orderBy(F.xxhash64("v", F.lit(seed)), "v").limit(SAMPLE_ROWS).toArrow()["v"].combine_chunks()
    if not len(sample):
        raise ValueError("no vectors to fit an index on")
    dim = len(sample[0])
    points = _matrix(sample, dim)
    lists = min(lists or round(sqrt(rows)) or 1, MAX_LISTS, max(1, len(points) // 4))
    parts = parts or max(p for p in range(1, max(dim // 4, 1) + 1) if dim % p == 0)
    if dim % parts:
        raise ValueError(f"{parts} equal parts do not make {dim} entries")
    centroids = k_means(points, lists, seed)
    width, rest = dim // parts, points - centroids[nearest(points, centroids)]
    spark = table.sparkSession
    shared = spark.sparkContext.broadcast(rest)

    def books(batches):
        import pandas as pd

        for frame in batches:
            for p in frame["id"].tolist():
                own = k_means(shared.value[:, p * width : (p + 1) * width], ENTRIES, seed + p)
                own = np.concatenate([own, np.repeat(own[:1], ENTRIES - len(own), 0)])
                yield pd.DataFrame({"part": [p], "entries": [own.ravel().tolist()]})

    found = spark.range(0, parts, 1, parts).mapInPandas(books, "part long, entries array<double>").orderBy("part").collect()
    return Coder(centroids, np.array([r.entries for r in found]).reshape(parts, ENTRIES, width))


class VectorIndex:
    """The index of a table below ``path``: ``rows`` holds all its columns and ``_code``, one folder per list; ``model`` what was fitted.

    A query reads the codes of its closest lists only, as a partition filter; the best of them are scored exactly by
    their vectors. Rows with a null vector are not indexed. Scores are dot products, as of unit vectors.
    """

    def __init__(self, spark: SparkSession, path: str, key: str = "chunk_id", vector: str = "embedding"):
        self.spark, self.path, self.key, self.vector = spark, path.rstrip("/"), key, vector
        rows = spark.read.parquet(f"{self.path}/model").orderBy("kind", "number").collect()
        centroids = np.array([r["values"] for r in rows if r["kind"] == "centroid"])
        books = [r["values"] for r in rows if r["kind"] == "book"]
        self.coder = Coder(centroids, np.array(books).reshape(len(books), ENTRIES, -1))

    @classmethod
    def build(
        cls, table: DataFrame, path: str, key: str = "chunk_id", vector: str = "embedding",
        lists: int | None = None, parts: int | None = None, seed: int = 42,
    ) -> VectorIndex:
        """Fit, code and write all rows of ``table``; ``lists`` is the square root of its rows by default. The path must be new."""
        coder = fit(table, vector, lists, parts, seed)
        spark = table.sparkSession
        model = [("centroid", i, c.tolist()) for i, c in enumerate(coder.centroids)] + [("book", p, b.ravel().tolist()) for p, b in enumerate(coder.books)]
        spark.createDataFrame(model, "kind string, number long, values array<double>").coalesce(1).write.parquet(f"{path.rstrip('/')}/model")
        index = cls(spark, path, key, vector)
        index.append(table)
        return index

    def append(self, rows: DataFrame) -> None:
        """Code further rows with the fitted model and add them to their lists."""
        shared, vector = self.spark.sparkContext.broadcast((self.coder.centroids, self.coder.books)), self.vector
        dim = self.coder.dim
        schema = T.StructType([*rows.schema.fields, T.StructField("_list", T.IntegerType()), T.StructField("_code", T.BinaryType())])

        def run(batches):
            import pyarrow as pa

            coder = Coder(*shared.value)
            for batch in batches:
                own, codes = coder.encode(_matrix(batch.column(vector), dim))
                columns = [*batch.columns, pa.array(own.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "_list", "_code"])

        coded = rows.where(F.col(vector).isNotNull()).mapInArrow(run, schema)
        coded.hint("rebalance", "_list").write.mode("append").partitionBy("_list").parquet(f"{self.path}/rows")

    def read(self) -> DataFrame:
        """All indexed rows with ``_list`` and ``_code``."""
        return self.spark.read.parquet(f"{self.path}/rows")

    def probes(self, share: float = PROBES) -> int:
        return max(1, ceil(share * len(self.coder.centroids)))

    def candidates(self, query_vector: Sequence[float], count: int, probes: int, where: Column | None = None) -> DataFrame:
        """``key`` and ``_list`` of the ``count`` rows of the closest lists whose codes score highest."""
        query = np.array([query_vector], np.float64)
        if query.shape[1] != self.coder.dim:
            raise ValueError(f"the query has {query.shape[1]} entries, not {self.coder.dim}")
        lists = [int(i) for i in self.coder.probes(query, probes)[0]]
        rows = self.read().where(F.col("_list").isin(lists))
        rows = rows if where is None else rows.where(where)
        shared, key = self.spark.sparkContext.broadcast((self.coder.centroids, self.coder.books)), self.key

        def run(batches):
            import pyarrow as pa

            coder = Coder(*shared.value)
            for batch in batches:
                own = batch.column("_list").to_numpy()
                codes = np.frombuffer(b"".join(batch.column("_code").to_pylist()), np.uint8).reshape(batch.num_rows, coder.parts)
                score = np.zeros(batch.num_rows)
                for i in np.unique(own):
                    score[own == i] = coder.scores(query, int(i), codes[own == i])[0]
                yield pa.RecordBatch.from_arrays([batch.column(key), batch.column("_list"), pa.array(score)], names=[key, "_list", "_about"])

        schema = T.StructType([rows.schema[key], T.StructField("_list", T.IntegerType()), T.StructField("_about", T.DoubleType())])
        return rows.select(key, "_list", "_code").mapInArrow(run, schema).orderBy(F.desc("_about"), key).limit(count).drop("_about")

    def search(
        self, query_vector: Sequence[float], k: int = 5, where: Column | None = None, probes: int | None = None, shortlist: int | None = None,
    ) -> DataFrame:
        """About the ``k`` most similar rows, with the columns and the exact ``score`` of an exact search."""
        found = self.candidates(query_vector, shortlist or SHORTLIST * k, probes or self.probes(), where)
        chosen = small_side(found)
        lists = [r[0] for r in chosen.select("_list").distinct().collect()]
        rows = self.read().where(F.col("_list").isin(lists)).drop("_code").join(chosen, [self.key, "_list"], "left_semi").drop("_list")
        return rows.withColumn("score", vx.dot(self.vector, vx.literal(query_vector))).drop(self.vector).orderBy(F.desc("score"), self.key).limit(k)

    def search_batch(
        self, queries: DataFrame, k: int = 5, where: Column | None = None, probes: int | None = None, shortlist: int | None = None,
        query_id: str = "query_id", query_vector: str = "query_vector",
    ) -> DataFrame:
        """``(query_id, rank, key, score)`` of about the ``k`` most similar rows of every query.

        A query goes to its closest lists. Lists are cut into parts of about ``PART_ROWS`` rows and queries into blocks of
        about ``QUERY_BYTES``, so a task holds one part of one list and the queries of one block.
        """
        probes, shortlist = probes or self.probes(), shortlist or SHORTLIST * k
        key, vector, dim, spark = self.key, self.vector, self.coder.dim, self.spark
        rows = self.read() if where is None else self.read().where(where)
        large = self.read().groupBy("_list").count().where(F.col("count") > PART_ROWS).collect()  # at most MAX_LISTS numbers
        pairs = [F.lit(x) for r in large for x in (r[0], ceil(r[1] / PART_ROWS))]
        parts = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("_list")), F.lit(1)) if pairs else F.lit(1)
        n = queries.count()
        blocks = max(1, ceil(n * dim * 8 / QUERY_BYTES))
        shared, at_once = spark.sparkContext.broadcast((self.coder.centroids, self.coder.books)), SCORES
        asked = queries.select(F.col(query_id).alias("_q"), F.col(query_vector).cast("array<double>").alias("_v"))

        def probe(batches):
            return routed(batches, Coder(*shared.value), probes, at_once)

        routes = asked.mapInArrow(probe, T.StructType([*asked.schema.fields, T.StructField("_lists", T.ArrayType(T.IntegerType()))]))
        sent = routes.select("_q", "_v", F.explode("_lists").alias("_list"))
        sent = sent.withColumns({"_block": F.pmod(F.xxhash64("_q", "_v"), F.lit(blocks)), "_part": F.explode(F.sequence(F.lit(0), parts - 1))})
        coded = rows.select(
            F.col(key).alias("_k"), "_code", "_list", F.pmod(F.xxhash64(key), parts).cast("int").alias("_part"),
            F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")).alias("_block"))

        def scan(left, right):
            import pyarrow as pa

            names = ["_q", "_k", "_list", "_about"]
            empty = pa.table([left.column("_q").slice(0, 0), right.column("_k").slice(0, 0), pa.array([], pa.int32()), pa.array([], pa.float64())], names=names)
            if not left.num_rows or not right.num_rows:
                return empty
            coder, own = Coder(*shared.value), left.column("_list")[0].as_py()
            asked, found = _matrix(left.column("_v").combine_chunks(), dim), [empty]
            codes = np.frombuffer(b"".join(right.column("_code").to_pylist()), np.uint8).reshape(right.num_rows, coder.parts)
            step = max(1, at_once // len(codes))
            for i in range(0, len(asked), step):
                about = coder.scores(asked[i : i + step], own, codes)
                best = min(shortlist, len(codes))
                at = np.argpartition(-about, best - 1, axis=1)[:, :best]
                query = np.repeat(np.arange(i, i + len(about)), best)
                found.append(pa.table([
                    left.column("_q").take(pa.array(query)), right.column("_k").take(pa.array(at.ravel())),
                    pa.array(np.full(at.size, own, np.int32)), pa.array(np.take_along_axis(about, at, 1).ravel())], names=names))
            return pa.concat_tables(found)

        best = sent.groupBy("_list", "_part", "_block").cogroup(coded.groupBy("_list", "_part", "_block")).applyInArrow(scan, T.StructType([
            asked.schema["_q"], T.StructField("_k", rows.schema[key].dataType), T.StructField("_list", T.IntegerType()), T.StructField("_about", T.DoubleType())]))
        order = Window.partitionBy("_q").orderBy(F.desc("_about"), "_k")
        short = best.withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= shortlist).select("_q", "_k", "_list")
        scored = short.join(rows.select(F.col(key).alias("_k"), "_list", F.col(vector).cast("array<double>").alias("_own")), ["_k", "_list"]).join(asked, "_q")
        scored = scored.select("_q", "_k", vx.dot("_own", F.col("_v")).alias("score"))
        ranking = Window.partitionBy("_q").orderBy(F.desc("score"), "_k")
        return scored.withColumn("rank", F.row_number().over(ranking).cast("long")).where(F.col("rank") <= k).select(
            F.col("_q").alias(query_id), "rank", F.col("_k").alias(key), "score")

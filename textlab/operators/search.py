"""Filtered top-k cosine search over a table of unit vectors."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import ceil
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlab.functions import text as tx
from textlab.functions import vector as vx

HIGH_PRIORITIES = ["high", "highest"]
QUERY_BYTES = 8 * 1024 * 1024    # query vectors of a block, about
VECTOR_BYTES = 8 * 1024 * 1024   # stored vectors that a block meets at once, about
SCORES = 4_000_000               # scores held at once in a task


def filters(
    company: str | None = None,
    date_range: tuple[str, str] | None = None,
    high_priority_only: bool = False,
    sections: Sequence[int] | None = None,
) -> Column | None:
    """The conjunction of the given conditions; falsy arguments and an empty list mean no condition."""
    conditions = []
    if company:
        conditions.append(F.col("company") == company)
    if date_range:
        start, end = (F.lit(d).cast("date") for d in date_range)
        conditions.append(F.col("reportDate").between(start, end))
    if high_priority_only:
        conditions.append(F.col("priority").isin(HIGH_PRIORITIES))
    if sections:
        conditions.append(F.col("section").isin(list(sections)))
    return reduce(and_, conditions) if conditions else None


def search(
    table: DataFrame,
    query_vector: Sequence[float],
    k: int = 5,
    where: Column | None = None,
    key: str = "chunk_id",
    vector: str = "embedding",
) -> DataFrame:
    """The ``k`` most similar rows with their ``score``, without the vectors; equal scores by key.

    A null vector has a null score and comes last; a vector of another length than the query is an error.
    """
    rows = table if where is None else table.filter(where)
    return (
        rows.withColumn("score", vx.dot(checked(vector, len(query_vector)), vx.literal(query_vector)))
        .drop(vector)
        .orderBy(F.desc("score"), key)
        .limit(k)
    )


def checked(vector: str, dim: int) -> Column:
    """The vector itself; an error where it does not have ``dim`` entries."""
    wrong = F.raise_error(F.concat(F.lit("a stored vector has "), F.size(vector).cast("string"), F.lit(f" entries, not {dim}")))
    return F.when(F.col(vector).isNull() | (F.size(vector) == dim), F.col(vector)).otherwise(wrong)


def search_batch(
    table: DataFrame,
    queries: DataFrame,
    k: int = 5,
    where: Column | None = None,
    key: str = "chunk_id",
    vector: str = "embedding",
    query_id: str = "query_id",
    query_vector: str = "query_vector",
    max_query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """Top ``k`` per query: ``(query_id, rank, key, score)``.

    Queries are dealt into blocks of about ``max_query_bytes`` and vectors into parts; every block meets every part in
    a task of its own, which keeps only the best ``k`` rows per query. Neither goes through the driver. Both are dealt by
    hash, so equal rows stay together. A query vector that is null or of another length than the others is an error.
    """
    rows = (table if where is None else table.filter(where)).select(key, vector)
    n, known, dim, least = queries.agg(
        F.count(F.lit(1)), F.count(query_vector), F.max(F.size(query_vector)), F.min(F.size(query_vector))).first()
    if n != known or dim != least:
        raise ValueError("query vectors are null or of different lengths")
    blocks = max(1, ceil(n * (dim or 1) * 8 / max_query_bytes))
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, ceil(rows.count() * (dim or 1) * 8 / VECTOR_BYTES))
    asked = queries.select(
        F.pmod(F.xxhash64(query_id, query_vector), F.lit(blocks)).alias("_block"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<long>")).alias("_part"), query_id, query_vector)
    stored = rows.select(
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")).alias("_block"),
        F.pmod(F.xxhash64(key, vector), F.lit(parts)).alias("_part"), key, vector)
    best = _best_per_task(asked, stored, k, key, query_id, T.StructType([
        queries.select(query_id).schema[0], rows.schema[key], T.StructField("score", T.DoubleType())]))
    ranking = Window.partitionBy(query_id).orderBy(F.desc("score"), key)
    return (
        best.withColumn("rank", F.row_number().over(ranking))
        .filter(F.col("rank") <= k)
        .select(query_id, F.col("rank").cast("long").alias("rank"), key, "score")
    )


def _best_per_task(asked: DataFrame, stored: DataFrame, k: int, key: str, query_id: str, schema: T.StructType) -> DataFrame:
    at_once = SCORES

    def scan(left, right):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        left, right = left.drop_columns(["_block", "_part"]), right.drop_columns(["_block", "_part"])
        ids, batches = left.column(0).combine_chunks(), right.to_batches()
        nothing = pa.table([ids.slice(0, 0), right.column(0).slice(0, 0), pa.array([], pa.float64())], names=[query_id, key, "score"])
        if not len(ids) or not right.num_rows:
            return nothing
        matrix = np.vstack(left.column(1).to_pylist()).astype(np.float64)
        kept, cut = None, np.full(len(ids), -np.inf)
        step = max(1, at_once // len(ids))
        pieces = (b.slice(i, step) for b in batches for i in range(0, b.num_rows, step))
        for piece in pieces:
            piece = piece.filter(pc.is_valid(piece.column(1)))
            if piece.num_rows == 0:
                continue
            if piece.column(1).flatten().null_count or set(pc.unique(pc.list_value_length(piece.column(1))).to_pylist()) != {matrix.shape[1]}:
                raise ValueError(f"a stored vector does not have {matrix.shape[1]} entries, or one of them is null")
            block = np.asarray(piece.column(1).flatten(), dtype=np.float64).reshape(piece.num_rows, -1)
            scores = matrix @ block.T
            best = min(k, scores.shape[1])
            # everything that reaches the k-th score stays, so that equal scores are cut by key later
            least = np.maximum(cut, np.partition(scores, -best, axis=1)[:, -best])
            at_query, at_row = np.nonzero(scores >= least[:, None])
            found = pa.table({
                "q": pa.array(at_query),
                "key": piece.column(0).take(pa.array(at_row)),
                "score": pa.array(scores[at_query, at_row]),
            })
            merged = found if kept is None else pa.concat_tables([kept, found])
            merged = merged.sort_by([("q", "ascending"), ("score", "descending"), ("key", "ascending")])
            q = merged.column("q").to_numpy()
            starts = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
            within = np.arange(len(q)) - np.repeat(starts, np.diff(np.r_[starts, len(q)]))
            kept = merged.filter(pa.array(within < k))
            full = within == k - 1
            cut[q[full]] = merged.column("score").to_numpy()[full]
        if kept is None:
            return nothing
        return pa.table(
            [ids.take(kept.column("q").combine_chunks()), kept.column("key"), kept.column("score")],
            names=[query_id, key, "score"],
        )

    return asked.groupBy("_block", "_part").cogroup(stored.groupBy("_block", "_part")).applyInArrow(scan, schema)


def display(results: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Presentation rows of one search: rank, score to 4 places, payload and a 300-character preview."""
    ranked = results.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("score"), key)).cast("long"))
    return ranked.select(
        "rank",
        F.round("score", 4).alias("score"),
        "company", "section",
        F.coalesce("section_name", F.lit("Unknown")).alias("section_name"),
        F.col("reportDate").cast("string").alias("report_date"),
        F.coalesce("priority", F.lit("unknown")).alias("priority"),
        tx.preview("text", 300, always=True).alias("text_preview"),
        F.col(key).alias("chunk_id"),
    )


def require_rows(results: DataFrame) -> int:
    """The number of hits; raises when a search found nothing."""
    n = results.count()
    if n == 0:
        raise ValueError("the search returned no rows")
    return n


def approximate_index(
    table: DataFrame, vector: str = "embedding", tables: int = 8, bucket: float = 0.5, seed: int = 42
):
    """A fitted random-projection index over unit vectors, where Euclidean order is cosine order.

    The defaults are chosen for recall; the README gives what they were measured at.
    """
    from pyspark.ml.feature import BucketedRandomProjectionLSH

    lsh = BucketedRandomProjectionLSH(
        inputCol="_vector", outputCol="_hashes", numHashTables=tables, bucketLength=bucket, seed=seed
    )
    return lsh.fit(_as_ml_vector(table, vector))


def _as_ml_vector(df: DataFrame, vector: str) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    return df.withColumn("_vector", array_to_vector(F.col(vector).cast("array<double>")))


def search_approximate(
    model, table: DataFrame, query_vector: Sequence[float], k: int = 5, vector: str = "embedding"
) -> DataFrame:
    """About the ``k`` most similar rows: only rows sharing a hash bucket with the query are scored."""
    from pyspark.ml.linalg import Vectors

    near = model.approxNearestNeighbors(
        _as_ml_vector(table.withColumn(vector, checked(vector, len(query_vector))), vector), Vectors.dense(list(query_vector)), k, distCol="_distance"
    )
    score = 1 - F.col("_distance") * F.col("_distance") / 2
    return near.withColumn("score", score).drop(vector, "_vector", "_hashes", "_distance")

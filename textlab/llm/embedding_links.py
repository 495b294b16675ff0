"""Embedding near-duplicates by a PCA-ordered tiled comparison."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.components import components
from textlab.llm.staging import staged

BLOCK = 8192      # vectors of one side of a task
TILE = 1024       # rows and columns of one matrix product
CANDIDATES = 1 << 16  # pairs of a tile that are computed further at once
SLACK = 1e-9      # rounding of a bound; a pair within it is computed in full
MARGIN = 1e-12    # rounding of a cosine that is equal to the threshold on paper


def _units(vectors) -> np.ndarray:
    x = np.array(vectors.to_pylist(), np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def second_moments(distinct: DataFrame, dim: int) -> np.ndarray:
    """Sum of the outer products of the unit vectors; ``dim`` x ``dim`` whatever the rows."""

    def sums(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            x = _units(batch.column("vector"))
            total += x.T @ x
        i, j = np.divmod(np.arange(dim * dim), dim)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total.ravel())], names=["i", "j", "s"])

    found = np.zeros((dim, dim))
    for row in distinct.select("vector").mapInArrow(sums, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).toLocalIterator():
        found[row["i"], row["j"]] = row["s"]
    return found


def near_pairs(a: np.ndarray, b: np.ndarray, threshold: float):
    """Rows of ``a`` and ``b`` (unit vectors, leading components first) with a dot product of at least ``threshold``.

    The leading components are multiplied first. What the rest can add is at most the product of the two
    suffix norms; a pair stops where even that does not reach the threshold.
    """
    dim = a.shape[1]
    cuts = sorted({max(1, dim // 4), max(1, dim // 2), dim})
    norms = [(np.sqrt((a[:, k:] ** 2).sum(axis=1)), np.sqrt((b[:, k:] ** 2).sum(axis=1))) for k in cuts]
    for top in range(0, len(a), TILE):
        for side in range(0, len(b), TILE):
            lead = a[top : top + TILE, : cuts[0]] @ b[side : side + TILE, : cuts[0]].T
            bound = lead + norms[0][0][top : top + TILE, None] * norms[0][1][None, side : side + TILE]
            rows, columns = np.nonzero(bound >= threshold - SLACK)
            for at in range(0, len(rows), CANDIDATES):
                i, j = rows[at : at + CANDIDATES], columns[at : at + CANDIDATES]
                part = lead[i, j]
                i, j = i + top, j + side
                for (start, end), (x, y) in zip(zip(cuts, cuts[1:]), norms[1:]):
                    part = part + np.einsum("ij,ij->i", a[i, start:end], b[j, start:end])
                    keep = part + x[i] * y[j] >= threshold - SLACK
                    i, j, part = i[keep], j[keep], part[keep]
                keep = part >= threshold - MARGIN
                yield i[keep], j[keep]


def _joined(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``label``, the smallest member of every node's component, after the links ``i``-``j``.

    Roots are hooked, not nodes: all that was joined to a root moves with it.
    """
    while True:
        a, b = label[i], label[j]
        apart = a != b
        if not apart.any():
            return label
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        label = label.copy()
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label[label] != label).any():
            label = label[label]


def _block_links(key, weight, y, side, same: bool, threshold: float) -> pa.RecordBatch:
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 0 if same else side == 1)
    links, label = np.zeros(len(key), np.int64), np.arange(len(key))
    for i, j in near_pairs(y[left], y[right], threshold):
        i, j = left[i], right[j]
        if same:
            i, j = i[i < j], j[i < j]
        np.add.at(links, i, weight[j])
        np.add.at(links, j, weight[i])
        label = _joined(label, i, j)
    found = np.flatnonzero((links > 0) | (label != np.arange(len(key))))
    return pa.RecordBatch.from_arrays([pa.array(key[found]), pa.array(key[label[found]]), pa.array(links[found])], names=["a", "b", "links"])


def _links_of_size(distinct: DataFrame, dim: int, threshold: float, block: int) -> DataFrame:
    """``a, b, links``: partial link counts of ``a``, and edges that span what is linked."""
    values, axes = np.linalg.eigh(second_moments(distinct, dim))
    axes = axes[:, np.argsort(values)[::-1]]

    def project(batches):
        for batch in batches:
            y = _units(batch.column("vector")) @ axes
            yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("copies"), pa.array(y[:, 0]), pa.array(list(y), pa.list_(pa.float64()))], names=["key", "copies", "lead", "y"])

    projected = staged(distinct.select("key", "copies", "vector").mapInArrow(project, "key long, copies long, lead double, y array<double>"), "projected")
    count = projected.count()
    if not count:
        return projected.selectExpr("key a", "key b", "copies links")
    parts = math.ceil(count / block)
    bounds = projected.approxQuantile("lead", [i / parts for i in range(1, parts)], 0.1 / parts) if parts > 1 else []
    strips = projected.withColumn("strip", reduce(lambda c, b: c + (F.col("lead") > b).cast("int"), bounds, F.lit(0)) if len(bounds) < 50 else
                                  F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col("lead"))))
    # Strips of one leading value can be large: they are split by key, so that no block is.
    sizes = staged(strips.groupBy("strip").agg(F.count("*").alias("n"), F.min("lead").alias("low"), F.max("lead").alias("high")), "strips")
    blocks = sizes.select("strip", "low", "high", F.ceil(F.col("n") / block).alias("splits")).withColumn("part", F.explode(F.expr("sequence(0, splits - 1)")))
    # Unit vectors of cosine t lie within sqrt(2 - 2t) of each other, and so do their leading components.
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + SLACK
    listed = [(r["strip"], r["part"], r["splits"], r["low"], r["high"]) for r in blocks.orderBy("strip", "part").toLocalIterator()]
    fits: dict = {}
    for i, x in enumerate(listed):
        for j in range(i, len(listed)):
            if listed[j][3] - x[4] > reach:
                break
            fits.setdefault(i, []).append((i, j, 0))
            if i != j:
                fits.setdefault(j, []).append((i, j, 1))
    places = distinct.sparkSession.createDataFrame(
        [(x[0], x[1], [{"l": l, "r": r, "side": s} for l, r, s in fits[i]]) for i, x in enumerate(listed)],
        "strip int, part long, pairs array<struct<l:int,r:int,side:int>>")
    splits = sizes.select("strip", F.ceil(F.col("n") / block).alias("splits"))
    dealt = strips.join(splits, "strip").withColumn("part", F.pmod(F.xxhash64("key"), F.col("splits"))).join(places, ["strip", "part"])
    copies = dealt.select(F.inline("pairs"), "key", "copies", "y")

    def compare(pair, table):
        y = np.array(table.column("y").to_pylist(), np.float64)
        out = _block_links(table.column("key").to_numpy(), table.column("copies").to_numpy(), y, table.column("side").to_numpy(), pair[0].as_py() == pair[1].as_py(), threshold)
        return pa.Table.from_batches([out])

    return copies.groupBy("l", "r").applyInArrow(compare, "a long, b long, links long")


def link_vectors(vectors: DataFrame, threshold: float = 0.9, vec_id: str = "vec_id", vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """Every row of ``vectors`` with ``n_links``, ``component_id`` and ``kept``.

    Two vectors link at a cosine, in double precision, of at least ``threshold`` (above 0). Equal vectors are
    collapsed first and counted with their number, so a large group of copies is one vector. A vector that is null,
    empty, zero or holds a null or non-finite entry links with nothing and is a component of its own; vectors of
    different lengths never link. A row with a null id keeps a null component unless it is linked; repeated rows count
    as vectors of their own. Columns named like a result are replaced, others stay. Empty tables give no rows.
    """
    rows = vectors.drop("n_links", "component_id", "kept")
    value = F.transform(F.col(f"`{vector}`"), lambda x: x.cast("double") + F.lit(0.0))
    packed = rows.select(F.struct("*").alias("row"), F.col(f"`{vec_id}`").alias("id"), value.alias("v"))  # no name of a column can clash
    good = F.coalesce(F.expr("size(v) > 0 AND forall(v, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(v, x -> x <> 0)"), F.lit(False))
    valid = packed.select("id", "v").where(good)
    distinct = staged(valid.groupBy("v").agg(F.count("*").alias("copies"), F.min("id").alias("least")).select(
        F.monotonically_increasing_id().alias("key"), F.col("v").alias("vector"), "copies", "least"), "vectors")
    sizes = [r[0] for r in distinct.select(F.size("vector")).distinct().toLocalIterator()]
    found = [_links_of_size(distinct.where(F.size("vector") == d), d, threshold, block) for d in sizes]
    empty = distinct.selectExpr("key a", "key b", "copies links").limit(0)
    links = staged(reduce(DataFrame.unionByName, found, empty), "links")
    counts = links.groupBy(F.col("a").alias("key")).agg(F.sum("links").alias("others"))
    joined = distinct.select("key", "vector", "copies", "least").join(counts, "key", "left").join(
        components(links.select("a", "b")).withColumnRenamed("node", "key"), "key", "left"
    ).withColumn("component", F.coalesce("component", "key"))
    firsts = staged(joined.groupBy("component").agg(F.min("least").alias("first")), "firsts")
    known = staged(joined.join(firsts, "component").select(
        F.col("vector").alias("v"), (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n"), "first"), "known")
    marked = packed.withColumn("v", F.when(good, F.col("v"))).withColumn(
        "v", F.coalesce("v", F.array(F.xxhash64("id").cast("double"), F.lit(float("nan")))))
    component = F.coalesce("first", "id")
    return marked.join(known, "v", "left").select(
        "row.*", F.coalesce("n", F.lit(0)).alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"))

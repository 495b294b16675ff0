"""Exact, repeatable samples and splits.

Rows are ordered by ``md5(seed|key)``. A sample is everything up to a cut in that order, so the rows themselves are only
filtered, never sorted. The cut of a small sample comes from the smallest hashes of every task, which one pass keeps;
that of a large sample or a split, which grows with the rows, from counts per hash prefix.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlab.operators.sizing import MAX_SMALL_ROWS, small_side
from textlab.session import shared_path

PREFIX = 3                 # hex digits per narrowing step: 4,096 counts per stratum
RANK_ROWS = 1_000_000      # rows of one prefix that may be ranked in one task
BOTTOM_ROWS = 50_000       # rows of a stratum up to which a sample keeps its smallest hashes in one pass
MERGE_ROWS = 2_000_000     # hashes of all tasks that one task may rank
CUT_ROWS = 65_536          # rows that a task takes in, at least, before it cuts what it holds


def hash_order(key: Sequence[str], seed: int) -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]).cast("binary"))


def quota_cuts(
    df: DataFrame, by: Sequence[str], key: Sequence[str], seed: int, quota: Callable[[Column], Column]
) -> DataFrame:
    """Per stratum the hash and key of its ``quota(size)``-th row: ``(_stratum, _cut)``.

    Strata with a quota of 0 are absent. Each step reads only the key columns; counts are
    combined before the shuffle, and only one prefix per stratum is ever ranked.
    """
    base = df.select(
        F.struct(*by).alias("_stratum") if by else F.lit(0).alias("_stratum"),
        F.struct(hash_order(key, seed).alias("h"), *[F.col(k) for k in key]).alias("_at"),
    )

    def boundary(rows: DataFrame, digits: int, rest: Column | None) -> DataFrame:
        prefix = F.substring("_at.h", 1, digits)
        group = ["_stratum", prefix.alias("_prefix")] + ([rest.alias("_rest")] if rest is not None else [])
        counts = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("_rows"))
        stratum = Window.partitionBy("_stratum")
        counts = counts.withColumns({
            "_upto": F.sum("_rows").over(stratum.orderBy("_prefix")),
            "_size": F.sum("_rows").over(stratum),
        })
        wanted = F.least(quota(F.col("_size")).cast("long"), F.col("_size")) if rest is None else F.col("_rest")
        before = F.col("_upto") - F.col("_rows")
        return small_side(
            counts.withColumn("_wanted", wanted)
            .filter((before < F.col("_wanted")) & (F.col("_wanted") <= F.col("_upto")))
            .select("_stratum", "_prefix", "_rows", (F.col("_wanted") - before).alias("_rest"))
        )

    def inside(edge: DataFrame, digits: int) -> DataFrame:
        keyed = base.withColumn("_prefix", F.substring("_at.h", 1, digits))
        return keyed.join(edge.select("_stratum", "_prefix", "_rest"), ["_stratum", "_prefix"])

    digits = PREFIX
    edge = boundary(base, digits, None)
    while digits < 32 and (edge.agg(F.max("_rows")).first()[0] or 0) > RANK_ROWS:
        edge = boundary(inside(edge, digits), digits + PREFIX, F.col("_rest"))
        digits += PREFIX
    ranked = inside(edge, digits).withColumn(
        "_rank", F.row_number().over(Window.partitionBy("_stratum").orderBy("_at"))
    )
    return small_side(
        ranked.filter(F.col("_rank") == F.col("_rest")).select("_stratum", F.col("_at").alias("_cut"))
    )


def kept_hashes(batches, keys: int, n: int):
    """Of Arrow batches ``(_stratum, _at)`` the ``n`` smallest ``_at`` of every stratum, and then the rows of each stratum.

    What is held is cut whenever as many rows came as half of what the last cut left, and ``CUT_ROWS`` at least.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    fields = [f"k{i}" for i in range(keys)]
    order = [(name, "ascending") for name in ("s", "h", *fields)]

    def cut(tables):
        whole = pa.concat_tables(tables).combine_chunks()
        keyed = pa.table([whole.column("_stratum"), *whole.column("_at").combine_chunks().flatten()], names=["s", "h", *fields])
        sorted_ = pc.sort_indices(keyed, sort_keys=order, null_placement="at_start").to_numpy()
        codes = whole.column("_stratum").combine_chunks().dictionary_encode().indices.to_numpy()[sorted_]
        heads = np.flatnonzero(np.diff(codes, prepend=-1))
        place = np.arange(len(codes)) - np.repeat(heads, np.diff(np.append(heads, len(codes))))
        return whole.take(pa.array(sorted_[place < n]))

    held, left, fresh, seen, schema = [], 0, 0, {}, None
    for batch in batches:
        schema = batch.schema
        for c in pc.value_counts(batch.column("_stratum")).to_pylist():
            seen[c["values"]] = seen.get(c["values"], 0) + c["counts"]
        held.append(pa.Table.from_batches([batch]))
        fresh += batch.num_rows
        if fresh > max(CUT_ROWS, left // 2):
            held = [cut(held)]
            left, fresh = held[0].num_rows, 0
    if schema is None:
        return
    kept, names = cut(held).combine_chunks(), list(seen)
    held.clear()
    written = pa.schema([(name, schema.field(name).type) for name in ("_stratum", "_at")] + [("_rows", pa.int64())])
    for part in kept.to_batches(max_chunksize=CUT_ROWS):
        yield pa.RecordBatch.from_arrays([part.column("_stratum"), part.column("_at"), pa.nulls(part.num_rows, pa.int64())], schema=written)
    yield pa.RecordBatch.from_arrays([
        pa.array(names, written.field("_stratum").type), pa.nulls(len(names), written.field("_at").type),
        pa.array([seen[x] for x in names], pa.int64())], schema=written)


def smallest_hashes(df: DataFrame, by: Sequence[str], key: Sequence[str], seed: int, n: int) -> tuple[DataFrame, int]:
    """One pass: the ``n`` smallest hashes of every stratum in every task and its number of rows, written to the shared
    folder, and how many rows that made.

    Hashes are rows ``(_stratum, _at)``, counts ``(_stratum, _rows)`` with a null ``_at``. Two such tables are merged by
    their union, as the smallest of all are among the smallest of each. A task holds at most half more than ``n`` rows per stratum, and ``CUT_ROWS``.
    """
    stratum = F.to_json(F.struct(*by), {"ignoreNullFields": "false"}) if by else F.lit("")
    rows = df.select(stratum.alias("_stratum"), F.struct(hash_order(key, seed).alias("h"), *[F.col(k) for k in key]).alias("_at"))
    keys = len(key)

    def run(batches):
        return kept_hashes(batches, keys, n)

    made = rows.mapInArrow(run, T.StructType([*[T.StructField(f.name, f.dataType) for f in rows.schema], T.StructField("_rows", T.LongType())]))
    path, seen = shared_path(df.sparkSession, "hashes"), Observation()
    made.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return df.sparkSession.read.schema(made.schema).parquet(path), seen.get["n"]


def bottom_cuts(
    df: DataFrame, by: Sequence[str], key: Sequence[str], seed: int, n: int, quota: Callable[[Column, Column], Column]
) -> list:
    """``(_stratum, _size, _total, _cut)`` of every stratum; ``quota(size, total)`` is at most ``n`` and a null cut means none.

    One pass over ``df``, and one over the hashes it keeps, in a single task where they are few.
    """
    hashes, made = smallest_hashes(df, by, key, seed, n)
    hashes = hashes.coalesce(1) if made <= MERGE_ROWS else hashes
    stratum = Window.partitionBy("_stratum")
    ranked = hashes.withColumns({
        "_size": F.sum("_rows").over(stratum),
        "_rank": F.row_number().over(stratum.orderBy(F.col("_at").isNull(), "_at")),
    }).where((F.col("_rank") <= n) | F.col("_at").isNull())
    # Counts of strata come first; there are few of them, so that one task adds them up.
    sizes = Window.partitionBy(F.lit(0))
    first = F.when(F.col("_at").isNull() & F.col("_rows").isNotNull(), F.col("_rows"))
    small = ranked.withColumn("_total", F.sum(first).over(sizes)) if made <= MERGE_ROWS else ranked.withColumn(
        "_total", F.lit(hashes.agg(F.sum("_rows")).first()[0] or 0))
    wanted = F.least(quota(F.col("_size"), F.col("_total")).cast("long"), F.col("_size"))
    at_cut = F.when((F.col("_rank") == wanted) & F.col("_at").isNotNull(), F.col("_at"))
    return small.groupBy("_stratum").agg(F.max("_size").alias("_size"), F.max("_total").alias("_total"), F.max(at_cut).alias("_cut")).collect()


def _mark(df: DataFrame, by: Sequence[str], key: Sequence[str], seed: int, cuts: DataFrame) -> DataFrame:
    """Add ``_stratum``, ``_at`` and the stratum's ``_cut`` (null where nothing is wanted)."""
    marked = df.withColumns({
        "_stratum": F.struct(*by) if by else F.lit(0),
        "_at": F.struct(hash_order(key, seed).alias("h"), *[F.col(k) for k in key]),
    })
    return marked.join(cuts, "_stratum", "left")


def _take(df: DataFrame, by: Sequence[str], key: Sequence[str], seed: int, cuts: DataFrame) -> DataFrame:
    return _mark(df, by, key, seed, cuts).filter(F.col("_at") <= F.col("_cut")).drop("_stratum", "_at", "_cut")


def _bound(df: DataFrame, key: Sequence[str], seed: int, cut) -> Column:
    """The rows up to a cut in the order of ``hash_order`` and the keys."""
    at = F.struct(hash_order(key, seed).alias("h"), *[F.col(k) for k in key])
    return at <= F.struct(F.lit(cut["h"]).alias("h"), *[F.lit(cut[k]).cast(df.schema[k].dataType).alias(k) for k in key])


def sample_n(df: DataFrame, n: int | None, key: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``n`` rows; all rows when ``n`` is falsy or not below the row count. ``key`` must be unique."""
    if not n:
        return df
    if n <= BOTTOM_ROWS:
        found = bottom_cuts(df, [], key, seed, n, lambda size, total: F.lit(n))
        return df.filter(_bound(df, key, seed, found[0]["_cut"])) if found and found[0]["_size"] > n else df
    cut = quota_cuts(df, [], key, seed, lambda size: F.lit(n)).select("_cut").first()
    return df if cut is None else df.filter(_bound(df, key, seed, cut[0]))


def stratified(
    df: DataFrame, n: int | None, by: Sequence[str], key: Sequence[str], seed: int = 42, floor: int = 10
) -> DataFrame:
    """Proportional sample: per stratum ``min(size, max(floor, int(n * size / total)))`` rows."""
    if not n:
        return df

    def quota(size: Column, total: Column) -> Column:
        return F.greatest(F.lit(floor), F.floor(F.lit(n) * size / total).cast("long"))

    if max(n, floor) <= BOTTOM_ROWS:
        found = bottom_cuts(df, by, key, seed, max(n, floor), quota)
        if not found or n >= found[0]["_total"]:
            return df
        at = F.struct(hash_order(key, seed).alias("h"), *[F.col(k) for k in key])
        cuts = df.sparkSession.createDataFrame(
            [(r["_stratum"], r["_cut"]) for r in found if r["_cut"]],
            T.StructType([T.StructField("_stratum", T.StringType()), T.StructField("_cut", df.select(at.alias("a")).schema["a"].dataType)]))
        name = F.to_json(F.struct(*by), {"ignoreNullFields": "false"}) if by else F.lit("")
        return df.withColumns({"_stratum": name, "_at": at}).join(F.broadcast(cuts) if len(found) <= MAX_SMALL_ROWS else cuts, "_stratum").filter(
            F.col("_at") <= F.col("_cut")).drop("_stratum", "_at", "_cut").select(*df.columns)
    total = df.count()
    if n >= total:
        return df
    return _take(df, by, key, seed, quota_cuts(df, by, key, seed, lambda size: quota(size, F.lit(total))))


def stratified_split(
    df: DataFrame, by: Sequence[str], key: Sequence[str], test: float = 0.2, seed: int = 42, exact: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with the same share of every stratum in both.

    ``exact=False`` assigns each row by its own hash: no counting, shares hold on average.
    """
    flagged = split_flag(df, by, key, test, seed, exact)
    return flagged.filter(~F.col("is_test")).drop("is_test"), flagged.filter("is_test").drop("is_test")


def split_flag(
    df: DataFrame, by: Sequence[str], key: Sequence[str], test: float = 0.2, seed: int = 42, exact: bool = True
) -> DataFrame:
    """``df`` with a boolean ``is_test``."""
    if not exact:
        slot = F.pmod(F.xxhash64(*key, F.lit(seed)), F.lit(10_000))
        return df.withColumn("is_test", slot < int(round(test * 10_000)))
    cuts = quota_cuts(df, by, key, seed, lambda size: F.round(size * F.lit(test)))
    return (
        _mark(df, by, key, seed, cuts)
        .withColumn("is_test", F.coalesce(F.col("_at") <= F.col("_cut"), F.lit(False)))
        .drop("_stratum", "_at", "_cut")
    )

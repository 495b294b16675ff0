"""Large JSON request files, read as byte ranges by many tasks."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlab.operators.sizing import small_side
from textlab.schemas import WINE_RECORD
from textlab.session import ensure_checkpoint_dir
from textlab.sources.files import read_requests

DEPTH = np.zeros(256, np.int64)  # what a byte outside of strings adds to the depth
DEPTH[[ord("{"), ord("[")]], DEPTH[[ord("}"), ord("]")]] = 1, -1
ARRAY_DEPTH = 2                  # depth between the records: inside the object and its array
HOLE = b"\x00"                   # stands for neighbouring records in what is left of a file; JSON holds no such byte
HOLES = re.compile(rb"\x00(?:[ \t\r\n]*,[ \t\r\n]*\x00)+")
REST_BYTES = 1 << 20             # what is left of a range, beyond which the file is read in one task

MEASURES = "file string, start long, at long, size long, bytes long, odd boolean, outside long, inside long"
STATES = "file string, start long, in_string boolean, depth long, broken boolean"
CUTS = "file string, start long, kind string, number long, value binary"


def _pieces(spark: SparkSession, path) -> DataFrame:
    """What lies between closing braces, which the scan can split anywhere: a byte range holds the pieces that begin in it."""
    text = spark.read.option("lineSep", "}").text(path)
    return text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"),
        F.col("_metadata.file_size").alias("size"), F.col("value").cast("binary").alias("piece"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[dict, bytes]]:
    """For neighbouring rows of one range: the first row without its piece, and all pieces with a brace after each."""
    heads, pieces = batch.drop_columns(["piece"]).to_pylist(), batch.column("piece").to_pylist()
    first = 0
    for i in range(1, len(heads) + 1):
        if i == len(heads) or (heads[i]["file"], heads[i]["start"]) != (heads[first]["file"], heads[first]["start"]):
            yield heads[first], b"".join(p + b"}" for p in pieces[first:i])
            first = i


def _odd(data: np.ndarray) -> np.ndarray:
    """Which bytes follow an odd number of quotes; one after an odd number of backslashes is none."""
    quote, slash = data == ord('"'), data == ord("\\")
    if slash.any():
        place = np.arange(len(data))
        plain = np.maximum.accumulate(np.where(slash, -1, place))  # the last byte so far that is no backslash
        quote[1:] &= (place[:-1] - plain[:-1]) % 2 == 0
    return np.cumsum(quote) % 2 == 1


def _measure(batches):
    """What each run of pieces does to a state it does not know: its quotes, and its depth from outside and from inside a string."""
    for batch in batches:
        rows = []
        for head, raw in _runs(batch):
            data = np.frombuffer(raw, np.uint8)
            odd, step = _odd(data), DEPTH[data]
            rows.append({**head, "bytes": len(data), "odd": bool(odd[-1]), "outside": int(step[~odd].sum()), "inside": int(step[odd].sum())})
        if rows:
            yield pa.Table.from_pandas(pd.DataFrame(rows), preserve_index=False).to_batches()[0]


def _carry(runs: pd.DataFrame) -> pd.DataFrame:
    """The state at the start of each range of one file; a file is broken that ends inside a string, object or array."""
    rows, in_string, depth = [], False, 0
    runs = runs.sort_values(["start", "at"])
    for row in runs.itertuples():
        if not rows or rows[-1][1] != row.start:
            rows.append([row.file, row.start, in_string, depth])
        depth += row.inside if in_string else row.outside
        in_string ^= row.odd
    # The last piece has no brace after it, unless the file ends with one (a byte order mark of 3 bytes is not read).
    added = int(runs["bytes"].sum()) - int(runs["size"].iloc[0]) in (1, -2)
    broken = in_string or depth + (1 if added else 0) > 0
    return pd.DataFrame([[*row, broken] for row in rows], columns=["file", "start", "in_string", "depth", "broken"])


class _Range:
    """Cuts the records out of one range, run by run."""

    def __init__(self, head: dict):
        self.file, self.start, self.in_string, self.depth = head["file"], head["start"], head["in_string"], head["depth"]
        self.number = -1                                          # records that began here, less one
        self.open = [] if self.depth > ARRAY_DEPTH else None      # parts of the record that is not closed yet
        self.rest = b""

    def cut(self, raw: bytes) -> list[tuple]:
        data = np.frombuffer(raw, np.uint8)
        odd = _odd(data) ^ self.in_string
        step = np.where(odd, 0, DEPTH[data])
        after = self.depth + np.cumsum(step)
        self.in_string, self.depth = bool(odd[-1]), int(after[-1])
        begins = np.flatnonzero((step > 0) & (after == ARRAY_DEPTH + 1) & (data == ord("{")))
        ends = np.flatnonzero((step < 0) & (after == ARRAY_DEPTH)) + 1
        rows, at, rest = [], 0, []
        while True:
            if self.open is not None:
                place = np.searchsorted(ends, at, "right")
                if place == len(ends):
                    self.open.append(raw[at:])
                    break
                kind, end = "head" if self.number < 0 else "record", int(ends[place])
                rows.append((self.file, self.start, kind, self.number, b"".join([*self.open, raw[at:end]])))
                self.open, at = None, end
            place = np.searchsorted(begins, at)
            begin = int(begins[place]) if place < len(begins) else len(raw)
            rest.append(raw[at:begin])
            if begin == len(raw):
                break
            rest.append(HOLE)
            self.number, self.open, at = self.number + 1, [], begin
        if self.rest is not None:
            self.rest = HOLES.sub(HOLE, self.rest + b"".join(rest))
            self.rest = self.rest if len(self.rest) <= REST_BYTES else None
        return rows

    def last(self) -> list[tuple]:
        left = [] if self.open is None else [(self.file, self.start, "head" if self.number < 0 else "tail", self.number, b"".join(self.open))]
        return [*left, (self.file, self.start, "rest", self.number + 1, self.rest)]


def _cut(batches):
    """``record``: a whole one; ``tail``, ``head``: parts of one that goes over the end or start of the range; ``rest``: all other bytes."""
    schema = pa.schema([("file", pa.string()), ("start", pa.int64()), ("kind", pa.string()), ("number", pa.int64()), ("value", pa.binary())])
    batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    own = None
    for batch in batches:
        rows = []
        for head, raw in _runs(batch):
            if own is None or (own.file, own.start) != (head["file"], head["start"]):
                rows += own.last() if own else []
                own = _Range(head)
            rows += own.cut(raw)
        if rows:
            yield batch_of(rows)
    if own:
        yield batch_of(own.last())


def _only_records(rest: bytes, key: str) -> bool:
    """Whether all holes are one run of records in the array ``key`` of the only object."""
    if rest.count(HOLE) != 1:
        return False
    try:
        fields = json.loads(rest.replace(HOLE, b"{}").decode("utf-8-sig"), object_pairs_hook=tuple)
    except ValueError:
        return False
    return isinstance(fields, tuple) and [v for k, v in fields if k == key] == [[()]]


def _number(key: str):
    def run(rests: pd.DataFrame) -> pd.DataFrame:
        """Records before each range of one file, and whether the file holds records in the array and nothing else of their kind."""
        rests = rests.sort_values("start")
        whole = None if rests["value"].isna().any() else HOLES.sub(HOLE, b"".join(map(bytes, rests["value"])))
        if whole is not None and bool(rests["added"].iloc[0]):
            whole = whole[:-1]
        return pd.DataFrame({"file": rests["file"], "start": rests["start"], "before": rests["number"].cumsum() - rests["number"],
                             "plain": whole is not None and _only_records(whole, key)})

    return run


def read_requests_by_range(spark: SparkSession, path: str) -> DataFrame:
    """What ``read_requests`` gives, but a file of many records is read by as many tasks as it has byte ranges of
    ``spark.sql.files.maxPartitionBytes``.

    One scan measures every range: its quotes, and its change of depth if it began outside or inside a string. Put
    together by file, a row for each range, they give the state in which each begins. A second scan cuts the records; those that go over
    an edge are put together from their parts. A record that does not fit its schema has the ``problem`` ``malformed record``
    and leaves the others of its file alone; a file cut short is a ``malformed file``. A file of any other form is read whole, in one task.
    """
    ensure_checkpoint_dir(spark)
    pieces = _pieces(spark, path)
    runs = pieces.mapInArrow(_measure, MEASURES).checkpoint()
    states = runs.groupBy("file").applyInPandas(_carry, STATES).checkpoint()
    added = runs.groupBy("file").agg((F.sum("bytes") - F.first("size")).isin(1, -2).alias("added"))
    sound = states.where("not broken").drop("broken")
    # After a join that shuffles, the rows of a range are in one partition, but not in order.
    known = pieces.join(small_side(sound), ["file", "start"]).sortWithinPartitions("file", "start", "at")
    cut = known.mapInArrow(_cut, CUTS).checkpoint()
    rests = cut.where("kind = 'rest'").join(small_side(added), "file")
    numbered = rests.groupBy("file").applyInPandas(_number("wines"), "file string, start long, before long, plain boolean").checkpoint()
    placed = cut.where("kind <> 'rest'").join(small_side(numbered.where("plain").drop("plain")), ["file", "start"])
    placed = placed.select("file", "start", "kind", (F.col("before") + F.col("number")).alias("position"), F.col("value").cast("string").alias("value"))
    parts = placed.where("kind <> 'record'").groupBy("file", "position").agg(F.sort_array(F.collect_list(F.struct("start", "value"))).alias("parts"))
    texts = placed.where("kind = 'record'").select("file", "position", "value").unionByName(
        parts.select("file", "position", F.array_join("parts.value", "").alias("value")))
    schema = T.StructType([*WINE_RECORD.fields, T.StructField("_corrupt", T.StringType())])
    parsed = texts.withColumn("wine", F.from_json("value", schema, {"columnNameOfCorruptRecord": "_corrupt"}))
    records = parsed.select(
        F.col("file").alias("batch_id"), "position", *[F.col("wine")[f.name].alias(f.name) for f in WINE_RECORD.fields],
        F.when(F.col("wine._corrupt").isNotNull(), F.lit("malformed record")).alias("problem"))
    broken = states.where("broken").select(F.col("file").alias("batch_id")).distinct().select(
        "batch_id", F.lit(None).cast("long").alias("position"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in WINE_RECORD.fields],
        F.lit("malformed file").alias("problem"))
    # The scan lists all paths on the driver in any case.
    empty = spark.read.format("binaryFile").load(path).where("length = 0").select(F.col("path").alias("file"))
    others = [unquote(r.file) for r in numbered.where("not plain").select("file").distinct().unionByName(empty).collect()]
    found = records.unionByName(broken)
    return found.unionByName(read_requests(spark, others)) if others else found

"""Token ids in files of shards, each compressed by a Re-Pair grammar that allows decoding of any document or range."""

from __future__ import annotations

import os
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textlab.llm.segments import SegmentCache, spread
from textlab.llm.staging import shared_folder
from textlab.llm.words import BYTE_CODES, MULTIPLIER, mix, powers, slices, text_bytes

END_ID = 2
SHARD_TOKENS = 1 << 20    # a shard ends with the document that reaches this
LEAST_COUNT = 5           # a rule takes 12 bytes and saves 3 a place: pairs of fewer places take less room without
RANGE = 4                 # pairs down to this part of the most frequent get rules in the same round
GRAMMAR = 1 << 24         # symbols are stored in three bytes
CACHED_PIECES = 1_500_000 # about 70 MB with their ids
CHAIN = 256               # pieces that the tokenizers library gets as one text
SIEVE_BITS = 20           # pairs are first counted, and chosen ones looked up, by so many bits of a hash
SHARDS = (
    "part int, shard int, doc_ids array<bigint>, symbols array<int>, tokens array<bigint>, "
    "vocabulary int, low binary, high binary, left binary, right binary, lengths binary"
)
#: Bytes that start white space beyond ASCII; no segment starts before one of them.
WIDE_SPACE = (0xC2, 0xE1, 0xE2, 0xE3)
STARTS_WORD = np.array([33 <= b <= 126 or b >= 0xC3 and b not in WIDE_SPACE for b in range(256)])


class Tokenizer:
    """Ids of the ``tokenizers`` library. The byte-level pattern always starts a token at a space that a visible character
    follows, so texts are cut there and each distinct piece is given to the library once, many of them in one text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer as Library

        self.library, self.cache = Library.from_file(path), SegmentCache(CACHED_PIECES)
        vocabulary = self.library.get_vocab()
        self.bytes_of = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        self.bytes_of[list(vocabulary.values())] = [len(t) for t in vocabulary]  # a character of a byte-level token is a byte
        for i, token in self.library.get_added_tokens_decoder().items():
            self.bytes_of[i] = len(token.content.encode())

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, and bounds of each row's ids."""
        data, offsets = text_bytes(column)
        cut = np.zeros(len(data), bool)
        cut[:-1] = (data[:-1] == 32) & STARTS_WORD[data[1:]]
        inner = cut.copy()
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        start = np.flatnonzero(cut)
        size = np.diff(np.append(start, len(data)))
        if not len(start):
            return np.zeros(0, np.int64), np.zeros(len(column) + 1, np.int64)
        place = np.arange(len(data)) - np.repeat(start, size)
        code = mix(np.add.reduceat(BYTE_CODES[data] * powers(int(size.max()))[place], start))
        flat = data.tobytes()

        def pieces(which):
            return [flat[a:b] for a, b in zip(start[which].tolist(), (start[which] + size[which]).tolist())]

        def solve(first):
            # Pieces that start at such a space can follow each other in one text.
            joined = inner[start[first]]
            alone, chained = self.each(pieces(first[~joined])), self.chain(pieces(first[joined]), size[first[joined]])
            place = np.empty(len(first), np.int64)
            place[np.concatenate([np.flatnonzero(~joined), np.flatnonzero(joined)])] = np.arange(len(first))
            ids, counts = np.concatenate([alone[0], chained[0]]), np.concatenate([alone[1], chained[1]])
            ids, counts = spread(ids, np.concatenate([[0], np.cumsum(counts)]), place)
            return ids, np.concatenate([[0], np.cumsum(counts)])

        ids, counts = self.cache.encode(code, solve)
        total = np.concatenate([[0], np.cumsum(counts)])
        return ids, total[np.searchsorted(start, offsets)]

    def each(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces, and their number by piece; each piece is a text."""
        found = [e.ids for e in self.library.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.int64), np.array([len(ids) for ids in found], np.int64)

    def chain(self, pieces: list[bytes], size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same, with ``CHAIN`` pieces in a text: the bytes that ids stand for tell where pieces end."""
        texts = [b"".join(pieces[i : i + CHAIN]) for i in range(0, len(pieces), CHAIN)]
        found = [np.array(e.ids, np.int64) for e in self.library.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]
        ids = np.concatenate([np.zeros(0, np.int64), *found])
        ends, wanted = np.cumsum(self.bytes_of[ids]), np.cumsum(size)
        at = np.searchsorted(ends, wanted)
        if len(pieces) and (ends[-1] != wanted[-1] or (ends[at] != wanted).any()):
            return self.each(pieces)  # another kind of tokenizer
        return ids, np.diff(at + 1, prepend=0)


@lru_cache(maxsize=1)
def tokenizer_of(path: str) -> Tokenizer:
    """One for all tasks that a Python worker runs."""
    return Tokenizer(path)


def compress(ids: np.ndarray, last: np.ndarray, vocabulary: int, least: int = LEAST_COUNT):
    """Re-Pair: ``(symbols, last, left, right)``; rule r is symbol ``vocabulary + r`` and stands for left[r] right[r].

    Each round counts all neighbours and gives rules to the most frequent and those down to a quarter of it;
    places that overlap are taken from the left. ``last`` marks the last id of a document, after which no pair goes on.
    """
    symbols, left, right = ids.astype(np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.flatnonzero(last)
    open_ = ~last[:-1]
    while True:
        # A pair that is too rare stays so: only places of the others and those around replaced ones are looked at again.
        at = np.flatnonzero(open_)
        pairs = symbols.take(at)
        pairs *= GRAMMAR
        pairs += symbols[1:].take(at)
        # A pair has at most the places of its cell of a short hash, so only pairs of cells of enough places are sorted and counted.
        cell = _short(pairs)
        places_of_cell = np.bincount(cell, minlength=1 << SIEVE_BITS).astype(np.int32)
        own = places_of_cell.take(cell)
        enough = max(least, int(own.max(initial=0)) // RANGE ** 2)
        while True:
            some = np.flatnonzero(own >= enough)
            found, counts = _frequent(pairs.take(some), enough)
            wanted = max(least, int(counts.max(initial=0)) // RANGE)
            if wanted >= enough:
                break
            enough = wanted  # the most frequent pair has fewer places than its cell promised
        if not len(counts):
            break
        chosen = found[counts >= wanted]
        if vocabulary + len(left) + len(chosen) >= GRAMMAR:
            break
        sieve = np.zeros(1 << SIEVE_BITS, bool)
        sieve[_short(chosen)] = True
        maybe = some[sieve.take(cell.take(some))]
        nearest = np.minimum(np.searchsorted(chosen, pairs[maybe]), len(chosen) - 1)
        met = chosen[nearest] == pairs[maybe]
        places, rules = at[maybe[met]], nearest[met]
        # In a run of neighbouring places every second one is taken.
        new_run = np.concatenate([[True], np.diff(places) > 1])
        run_start = places[np.flatnonzero(new_run)][np.cumsum(new_run) - 1]
        taken = (places - run_start) % 2 == 0
        places, rules = places[taken], rules[taken]
        used = np.bincount(rules, minlength=len(chosen)) > 0  # neighbours may have taken all places of a pair
        chosen, rules = chosen[used], (np.cumsum(used) - 1)[rules]
        symbols[places] = vocabulary + len(left) + rules
        left, right = np.concatenate([left, chosen // GRAMMAR]), np.concatenate([right, chosen % GRAMMAR])
        keep = np.ones(len(symbols), bool)
        keep[places + 1] = False
        mask = np.zeros(len(symbols), bool)
        mask[at] = own >= least
        mask[places], mask[np.maximum(places - 1, 0)] = True, True
        ends -= np.searchsorted(places + 1, ends, "right")
        symbols, open_ = symbols[keep], mask[keep]
        open_[ends] = False
        open_ = open_[:-1]
    last = np.zeros(len(symbols), bool)
    last[ends] = True
    return symbols, last, left, right


def _frequent(pairs: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of at least ``least`` places, ascending, and their places' number."""
    ranked = np.sort(pairs)
    # A pair of enough places is equal to the one ``least - 1`` further on, at all but its last places.
    head = ranked[: max(len(ranked) - least + 1, 0)]
    head = head[head == ranked[least - 1 :]]
    starts = np.flatnonzero(np.concatenate([[True], head[1:] != head[:-1]])) if len(head) else np.zeros(0, np.int64)
    return head[starts], np.diff(np.append(starts, len(head))) + least - 1 if len(head) else starts


def _short(pairs: np.ndarray) -> np.ndarray:
    return ((pairs.view(np.uint64) * MULTIPLIER) >> np.uint64(64 - SIEVE_BITS)).view(np.int64)


def rule_lengths(left: np.ndarray, right: np.ndarray, vocabulary: int) -> np.ndarray:
    """Ids that each rule stands for; a rule only uses earlier ones."""
    lengths, done = np.zeros(len(left), np.int64), 0
    while done < len(left):  # all rules whose parts are known
        upto = np.maximum(left, right)[done:] - vocabulary >= done
        end = done + int(upto.argmax()) if upto.any() else len(left)
        part = slice(done, end)
        for side in (left[part], right[part]):
            rule = side >= vocabulary
            lengths[part] += np.where(rule, lengths[np.where(rule, side - vocabulary, 0)], 1)
        done = end
    return lengths


def expand(symbols: np.ndarray, left: np.ndarray, right: np.ndarray, lengths: np.ndarray, vocabulary: int) -> np.ndarray:
    """The ids of symbols: every symbol is written at its place, then rules are replaced by their parts, which have known lengths."""
    size = lambda s: np.where(s >= vocabulary, lengths[np.where(s >= vocabulary, s - vocabulary, 0)] if len(lengths) else 1, 1)
    counts = size(symbols)
    at = np.cumsum(counts) - counts
    out = np.empty(int(counts.sum()), np.int64)
    while len(symbols):
        plain = symbols < vocabulary
        out[at[plain]] = symbols[plain]
        at, rules = at[~plain], symbols[~plain] - vocabulary
        first = left[rules]
        at = np.concatenate([at, at + size(first)])
        symbols = np.concatenate([first, right[rules]])
    return out


class Shard:
    """A stored shard; reads any range of a document without decoding the rest."""

    def __init__(self, row: dict):
        self.doc_ids, self.vocabulary = row["doc_ids"], row["vocabulary"]
        self.bounds = np.concatenate([[0], np.cumsum(np.array(row["symbols"], np.int64))])
        self.tokens = np.array(row["tokens"], np.int64)
        self.symbols = np.frombuffer(row["low"], "<u2").astype(np.int64) + (np.frombuffer(row["high"], np.uint8).astype(np.int64) << 16)
        self.left, self.right, self.lengths = (np.frombuffer(row[k], "<u4").astype(np.int64) for k in ("left", "right", "lengths"))

    def document(self, i: int, first: int = 0, count: int | None = None) -> np.ndarray:
        """``count`` ids of document ``i`` from ``first`` on: lengths lead to the symbols that hold them."""
        symbols = self.symbols[self.bounds[i] : self.bounds[i + 1]]
        rule = symbols >= self.vocabulary
        sizes = np.ones(len(symbols), np.int64)
        sizes[rule] = self.lengths[symbols[rule] - self.vocabulary]
        ends = np.cumsum(sizes)
        stop = int(ends[-1]) if count is None else min(first + count, int(ends[-1]))
        if first >= stop:
            return np.zeros(0, np.int64)
        a, b = np.searchsorted(ends, first, "right"), np.searchsorted(ends, stop, "left") + 1
        ids = expand(symbols[a:b], self.left, self.right, self.lengths, self.vocabulary)
        skipped = first - int(ends[a] - sizes[a])
        return ids[skipped : skipped + stop - first]

    def all_ids(self) -> np.ndarray:
        return expand(self.symbols, self.left, self.right, self.lengths, self.vocabulary)


def _pack(part: int, shard: int, doc_ids: list, counts: list, ids: list, vocabulary: int) -> dict:
    tokens = np.array(counts, np.int64)
    flat = np.concatenate(ids)
    last = np.zeros(len(flat), bool)
    last[np.cumsum(tokens) - 1] = True
    symbols, last, left, right = compress(flat, last, vocabulary)
    ends = np.flatnonzero(last) + 1
    return {
        "part": part, "shard": shard, "doc_ids": doc_ids, "symbols": np.diff(ends, prepend=0).tolist(), "tokens": tokens.tolist(), "vocabulary": vocabulary,
        "low": (symbols & 0xFFFF).astype("<u2").tobytes(), "high": (symbols >> 16).astype(np.uint8).tobytes(), "left": left.astype("<u4").tobytes(),
        "right": right.astype("<u4").tobytes(), "lengths": rule_lengths(left, right, vocabulary).astype("<u4").tobytes(),
    }


def write_tokens(docs: DataFrame, tokenizer_path: str, path: str, shard_tokens: int = SHARD_TOKENS) -> None:
    """Shards of ``docs`` (``doc_id``, ``text``) in ascending order of ``doc_id``, written below ``path`` as Parquet rows.

    Every document ends with id 2; null and empty texts are that id alone. Null ids come first; rows of one id are ordered by text.
    Documents are range-partitioned by id and hash of the text, so that many rows of one id are spread, and cut into shards that hold whole documents.
    The tokenizer's path is opened by the executors.
    """
    from pyspark import TaskContext

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fields = {"part": pa.int32(), "shard": pa.int32(), "doc_ids": pa.list_(pa.int64()), "symbols": pa.list_(pa.int32()), "tokens": pa.list_(pa.int64()), "vocabulary": pa.int32()}
    schema = pa.schema([(k, fields.get(k, pa.binary())) for k in (c.split()[0] for c in SHARDS.split(", "))])

    def run(batches):
        tokenizer, part, shard = tokenizer_of(tokenizer_path), TaskContext.get().partitionId(), 0
        vocabulary = max(tokenizer.library.get_vocab_size(), END_ID + 1)
        docs, counts, ids, held = [], [], [], 0
        for batch in slices(batches, limit=1 << 21):
            flat, bounds = tokenizer.encode(batch.column("text"))
            size = np.diff(bounds) + 1
            ended = np.full(int(size.sum()), END_ID, np.int64)
            ended[np.arange(len(flat)) + np.repeat(np.arange(len(size)), size - 1)] = flat
            edges = np.concatenate([[0], np.cumsum(size)])
            names, at = batch.column("doc_id").to_pylist(), 0
            while at < len(size):
                end = min(max(int(np.searchsorted(edges, edges[at] + shard_tokens - held, "left")), at + 1), len(size))
                docs, counts = docs + names[at:end], counts + size[at:end].tolist()
                ids.append(ended[edges[at] : edges[end]])
                held, at = held + int(edges[end] - edges[at]), end
                if held >= shard_tokens:
                    yield pa.RecordBatch.from_pylist([_pack(part, shard, docs, counts, ids, vocabulary)], schema=schema)
                    docs, counts, ids, held, shard = [], [], [], 0, shard + 1
        if docs:
            yield pa.RecordBatch.from_pylist([_pack(part, shard, docs, counts, ids, vocabulary)], schema=schema)

    texts.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(run, SHARDS).write.parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARDS).parquet(path)


def documents_of(shards: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document of stored shards, from their decoded ids."""
    ranks = shards.select("part", "shard", F.expr("aggregate(tokens, 0L, (s, x) -> s + x)").alias("n"))
    # One row per partition in one window, as many as files; shards are summed within their partition.
    sums = ranks.groupBy("part").agg(F.sum("n").alias("n")).select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    inner = ranks.select("part", "shard", (F.sum("n").over(Window.partitionBy("part").orderBy("shard")) - F.col("n")).alias("within"))
    starts = inner.join(sums, "part").select("part", "shard", (F.col("before") + F.col("within")).alias("first"))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                shard = Shard(row)
                raw, ends = shard.all_ids().astype("<u4"), np.cumsum(shard.tokens)
                begins = ends - shard.tokens
                crc = [zlib.crc32(raw[a:b].tobytes()) for a, b in zip(begins.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array(shard.doc_ids, pa.int64()), pa.array(begins + row["first"]), pa.array(shard.tokens), pa.array(crc, pa.int64())],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return shards.join(starts, ["part", "shard"]).mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def stored_tokens(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write the ids of ``docs`` into the shared folder and describe every document from what is read back."""
    path = shared_folder(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer_path, path)
    return documents_of(read_shards(docs.sparkSession, path))

"""N-gram Jaccard self-join of documents with adaptive multi-match prefixes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlab.llm.components import components
from textlab.llm.staging import staged
from textlab.llm.words import NOT_SPACE, mix, slices, words

LEVELS = 6                 # longest prefix extension that is considered
BUCKET_POSTINGS = 1 << 19  # postings that one group of the sieve holds on average
TARGET_SETS = 1 << 18      # sets whose counts one group adds up, at least as many groups as shuffle partitions
SLICE = 1 << 18            # bytes of text whose shingles a task makes at once
SIEVES = (20, 3)           # parts of a set by which the two sieves' prefixes are longer
FILTER_WORDS = 1 << 19     # 64-bit words of the largest filter of ids that is broadcast
WORD_IDS = 8               # ids that share a word of it


def shingle_sets(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all rows, ascending within a row; bounds of the rows; a hash of each row's set.

    Words are separated by spaces and the controls from tab to carriage return; A-Z lower-cased. A row of fewer than ``width``
    words, but not none, is one shingle. Equal 64-bit hashes count as equal shingles, and equal hashes of sets as equal sets.
    """
    found = words(column, NOT_SPACE)
    first, code = found.windows(width)
    doc = found.doc[first]
    for size in range(1, width):
        begin, short = found.windows(size)
        whole = np.diff(found.bounds)[found.doc[begin]] == size
        doc, code = np.concatenate([doc, found.doc[begin[whole]]]), np.concatenate([code, short[whole]])
    order = np.lexsort([code, doc])
    doc, code = doc[order], code[order]
    fresh = np.ones(len(doc), bool)
    fresh[1:] = (doc[1:] != doc[:-1]) | (code[1:] != code[:-1])
    doc, code = doc[fresh], code[fresh]
    bounds = np.searchsorted(doc, np.arange(len(column) + 1))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(code), dtype=np.uint64)])
    return code, bounds, mix(np.diff(sums[bounds]) + np.diff(bounds).astype(np.uint64))


def spare(n, percent: int):
    """Shingles of a set of ``n`` that a linked set may lack."""
    return n * (100 - percent) // 100


def document_sets(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n_shingles, key``: size and hash of every row's set."""

    def run(batches):
        for part in slices(batches, limit=SLICE):
            _, bounds, key = shingle_sets(part.column("text"), width)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(bounds)), pa.array(key.astype(np.int64))], names=["doc_id", "n_shingles", "key"])

    return docs.mapInArrow(run, "doc_id long, n_shingles long, key long")


def shared_counts(texts: DataFrame, width: int, percent: int, part_of: int, buckets: int, targets: int) -> DataFrame:
    """``key, shared``: for each distinct set at least the number of its prefix shingles that another set's prefix holds too.

    The order is that of the hashes. The prefix of a set of n has ``spare(n) + m`` shingles, m = n // part_of + 1, and linked sets share
    at least m of them. Postings travel as arrays, one row per batch and bucket of hashes. A shingle of several sets within
    a batch is settled there and only two of its postings travel, so a very common one is no hot group. Copies in several
    batches may be counted more than once, never less. A bucket's counts travel as arrays too, one row for each of
    ``targets`` groups of sets, and are added up there.
    """

    def cut(batches):
        for batch in batches:
            tokens, keys, seen = [], [], set()
            for part in slices([batch], limit=SLICE):
                code, bounds, key = shingle_sets(part.column("text"), width)
                for i in range(part.num_rows):
                    n = int(bounds[i + 1] - bounds[i])
                    if n and int(key[i]) not in seen:
                        seen.add(int(key[i]))
                        tokens.append(code[bounds[i] : bounds[i] + spare(n, percent) + n // part_of + 1])
                        keys.append(np.full(len(tokens[-1]), key[i]))
            if not tokens:
                continue
            token, key = np.concatenate(tokens), np.concatenate(keys)
            order = np.argsort(token)
            token, key = token[order], key[order]
            starts, several, repeat = _runs(token, key)
            own, counts = np.unique(key[repeat], return_counts=True)
            ends = np.append(starts[1:], len(token)) - 1
            # Within a batch a set is there once, so the ends of a run of several belong to different sets.
            sent = np.union1d(np.flatnonzero(~repeat), np.concatenate([starts[several], ends[several]]))
            bucket = (token[sent] >> np.uint64(32)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            sent, edges = sent[order], np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in np.flatnonzero(np.diff(edges)):
                at = sent[edges[b] : edges[b + 1]]
                rest = (own, counts) if b == bucket.min() else (own[:0], counts[:0])
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in (
                    (int(b), pa.int64()), (token[at].tobytes(), pa.binary()), (key[at].tobytes(), pa.binary()), (repeat[at].tobytes(), pa.binary()),
                    (rest[0].tobytes(), pa.binary()), (rest[1].astype(np.int64).tobytes(), pa.binary()))], names=["bucket", "tokens", "keys", "settled", "own", "counts"])

    def meet(table):
        join = lambda name, kind: np.concatenate([np.frombuffer(x.as_py(), kind) for x in table.column(name)])
        token, key, settled = join("tokens", np.uint64), join("keys", np.uint64), join("settled", bool)
        order = np.lexsort([settled, key, token])
        token, key, settled = token[order], key[order], settled[order]
        _, _, repeat = _runs(token, key)
        twice = np.zeros(len(token), bool)
        twice[1:] = (token[1:] == token[:-1]) & (key[1:] == key[:-1])
        counted = np.unique(key[repeat & ~settled & ~twice], return_counts=True)
        found, counts = _added(np.concatenate([join("own", np.uint64), counted[0]]), np.concatenate([join("counts", np.int64), counted[1]]))
        target = found % np.uint64(targets)
        order = np.argsort(target, kind="stable")
        edges = np.searchsorted(target[order], np.arange(targets + 1))
        rows = [(t, found[order[edges[t] : edges[t + 1]]].tobytes(), counts[order[edges[t] : edges[t + 1]]].tobytes()) for t in np.flatnonzero(np.diff(edges)).tolist()]
        return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int64(), pa.binary(), pa.binary()))], names=["target", "keys", "counts"])

    def add(table):
        join = lambda name, kind: np.concatenate([np.frombuffer(x.as_py(), kind) for x in table.column(name)])
        found, counts = _added(join("keys", np.uint64), join("counts", np.int64))
        return pa.table({"key": found.astype(np.int64), "shared": counts})

    rows = texts.select("text").mapInArrow(cut, "bucket long, tokens binary, keys binary, settled binary, own binary, counts binary")
    met = rows.groupBy("bucket").applyInArrow(meet, "target long, keys binary, counts binary")
    return met.groupBy("target").applyInArrow(add, "key long, shared long")


def _added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their counts."""
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(counts, starts) if len(keys) else counts


def _runs(token: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of sorted tokens: starts of the runs, which runs hold several keys, and the same for every posting."""
    starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]])) if len(token) else np.zeros(0, np.int64)
    several = np.minimum.reduceat(key, starts) != np.maximum.reduceat(key, starts) if len(token) else np.zeros(0, bool)
    return starts, several, np.repeat(several, np.diff(np.append(starts, len(token))))


def among(rows: DataFrame, ids: DataFrame, count: int) -> DataFrame:
    """The ``rows`` whose ``doc_id`` is one of the ``count`` distinct ``ids``, and a few per cent of the others, without a shuffle of ``rows``.

    A Bloom filter is broadcast that sets four bits of one 64-bit word for each id. Where its FILTER_WORDS would hold more than WORD_IDS
    ids each, ``rows`` are shuffled and joined with ``ids`` instead.
    """
    slots = count // WORD_IDS + 1
    if slots > FILTER_WORDS:
        return rows.join(ids, "doc_id", "left_semi")
    slot = F.pmod(F.xxhash64("doc_id"), F.lit(slots))
    bits = F.expr(" | ".join(f"shiftleft(1L, CAST(shiftright(xxhash64(doc_id, 1), {6 * i}) & 63 AS INT))" for i in range(4)))
    words = ids.groupBy(slot.alias("slot")).agg(F.bit_or(bits).alias("word"))
    return rows.join(F.broadcast(words), (slot == F.col("slot")) & (F.col("word").bitwiseAND(bits) == bits), "left_semi")


def _least_overlap(a: Column, b: Column, percent: int) -> Column:
    """Shingles that sets of these sizes share if they are linked."""
    return F.ceil((a + b) * percent / (100 + percent) - 1e-9)


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """``token, key, n, shared, at, level, reach``: the postings of every set that can have a link.

    Shingles are ordered by the number of sets that hold them, then by hash. Those of one set alone take up part of
    what a partner may lack; what is left over and ``l`` more are the l-prefix, and linked sets share l of their l-prefixes.
    ``level`` is the first l with the posting in it. ``reach`` is the set's own l: of 1 to LEVELS the one of least
    cost, which is the postings that are read plus the candidates they can make, at most postings / l, each as
    costly as a comparison of the set.
    """
    postings = sets.select("key", F.explode("tokens").alias("token"))
    frequency = staged(postings.groupBy("token").agg(F.count("*").alias("df")).where("df > 1"), "frequency")
    lists = postings.join(frequency, "token").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("df", "token"))).alias("list"))
    lists = lists.join(sets.select("key", "n"), "key")
    lists = lists.withColumn("shared", F.size("list").cast("long")).withColumn("left", F.floor(F.col("n") * (100 - percent) / 100).cast("long") - (F.col("n") - F.col("shared")))
    lists = lists.where("left >= 0").withColumn("list", F.slice("list", 1, F.greatest(F.lit(0), F.col("left") + LEVELS).cast("int")))
    costs = []
    for level in range(1, LEVELS + 1):
        read = F.aggregate(F.slice("list", 1, F.greatest(F.lit(0), F.col("left") + level).cast("int")), F.lit(0).cast("long"), lambda s, x: s + x["df"])
        possible = F.size("list") >= F.col("left") + level
        costs.append(F.when(possible, F.struct((read + read / level * F.col("n")).alias("cost"), F.lit(level).alias("level"))))
    chosen = F.coalesce(F.array_min(F.array_compact(F.array(*costs)))["level"], F.lit(1))
    spots = lists.withColumn("reach", chosen).select("key", "n", "shared", "left", "reach", F.posexplode("list").alias("at", "entry"))
    return spots.select("key", "n", "shared", "reach", "at", F.col("entry.token").alias("token"), F.greatest(F.lit(1), F.col("at") - F.col("left") + 1).cast("int").alias("level"))


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose whole sets are linked."""
    one = sets.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("tokens").alias("t_a"))
    two = sets.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("tokens").alias("t_b"))
    both = F.size(F.array_intersect("t_a", "t_b"))
    return pairs.join(one, "a").join(two, "b").where(100 * both >= percent * (F.col("n_a") + F.col("n_b") - both)).select("a", "b")


def _inner(near: DataFrame, sets: DataFrame) -> DataFrame:
    """``key, centre, size, inner, lacks``: for each set the one of its central sets that is near most sets, its size, how many
    shingles they share, and a bit for each of 64 classes of shingles of which the set lacks one: two sets lack at least as many as both have bits."""
    popular = near.groupBy("centre").agg(F.count("*").alias("c"))
    chosen = near.join(popular, "centre").groupBy("key").agg(F.max(F.struct("c", "centre"))["centre"].alias("centre"))
    # Both sides are renamed, so that they are one shuffle to the planner.
    one, two = (sets.select(F.col("key").alias(k), F.col("tokens").alias(t)) for k, t in (("key_", "own"), ("centre_", "theirs")))
    both = chosen.join(one, F.col("key") == F.col("key_")).join(two, F.col("centre") == F.col("centre_")).select("key", "centre", F.size("theirs").cast("long").alias("size"), F.array_except("theirs", "own").alias("missing"))
    lacks = F.expr("aggregate(missing, 0L, (bits, x) -> bits | shiftleft(1L, CAST(pmod(x, 64) AS INT)))")
    return both.select("key", "centre", "size", (F.col("size") - F.size("missing")).alias("inner"), lacks.alias("lacks"))


def set_links(sets: DataFrame, percent: int) -> DataFrame:
    """Edges ``a, b`` between linked ``sets`` (``key``, ``n``, ``tokens``) that connect all that links connect.

    Every posting's set is first compared with the most central set of the shingle, the one with the smallest part of its own
    alone. Pairs of sets that this leaves in different components are candidates if they share as many prefix shingles as
    the prefix of the smaller key reaches; pairs of one component need no comparison, as the answer would change nothing. A shared
    shingle counts only where its places in both lists leave room for the overlap that a link needs, and where what both share
    with a common central set, and what both hold beside it, leave that room too.
    """
    postings = staged(prefixes(sets, percent), "prefixes")
    central = F.struct((1 - F.col("shared") / F.col("n")).alias("alone"), "key", "n", "shared")
    hubs = staged(postings.where("level = 1").groupBy("token").agg(F.min(central).alias("hub"), F.count("*").alias("c")).where("c > 1").select("token", "hub"), "hubs")
    near = postings.where("level = 1").join(hubs, "token")
    inner = staged(_inner(near.select("key", F.col("hub.key").alias("centre")).distinct(), sets), "inner")
    stars = near.where("key <> hub.key").where(F.least("shared", "hub.shared") >= _least_overlap(F.col("n"), F.col("hub.n"), percent)).select(
        F.least("key", "hub.key").alias("a"), F.greatest("key", "hub.key").alias("b")).distinct()
    edges = staged(verified(stars, sets, percent), "stars")
    known = components(edges)
    labelled = staged(postings.join(known.withColumnRenamed("node", "key"), "key", "left").withColumn("component", F.coalesce("component", "key")), "labelled")
    mixed = staged(labelled.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("token"), "mixed")
    open_ = staged(labelled.join(mixed, "token").join(inner, "key", "left").withColumn("inner", F.least("inner", "shared")), "open")
    x, y = open_.alias("x"), open_.alias("y")
    need = _least_overlap(F.col("x.n"), F.col("y.n"), percent)
    # What two sets can share: all before the nearer place of a common shingle, and all from it on in the shorter rest.
    possible = F.least("x.at", "y.at") + F.least(F.col("x.shared") - F.col("x.at"), F.col("y.shared") - F.col("y.at"))
    common = F.least("x.inner", "y.inner", F.col("x.size") - F.bit_count(F.col("x.lacks").bitwiseOR(F.col("y.lacks"))))
    within = common + F.least(F.col("x.shared") - F.col("x.inner"), F.col("y.shared") - F.col("y.inner"))
    room = F.coalesce((F.col("x.centre") != F.col("y.centre")) | (within >= need), F.lit(True))
    met = x.join(y, (F.col("x.token") == F.col("y.token")) & (F.col("x.key") < F.col("y.key")) & (F.col("x.component") != F.col("y.component"))
                 & (F.col("x.level") <= F.col("x.reach")) & (F.col("y.level") <= F.col("x.reach"))
                 & (F.least("x.shared", "y.shared") >= need) & (F.least("x.n", "y.n") >= need) & (possible >= need) & room)
    candidates = met.groupBy(F.col("x.key").alias("a"), F.col("y.key").alias("b")).agg(F.count("*").alias("c"), F.first("x.reach").alias("reach")).where("c >= reach")
    return edges.unionByName(verified(candidates.select("a", "b"), sets, percent))


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs`` (``doc_id``, ``text``).

    Two documents are linked if their sets of ``width``-word shingles have a Jaccard similarity of ``percent`` % or more. Null or blank texts
    have empty sets and no links. Equal sets are collapsed to one before any pair is made. A row with a null id has no links and a null
    component; rows of one id are separate texts whose components are one by their id. An empty table gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    own = staged(document_sets(texts, width), "sets")
    known = own.where("n_shingles > 0 and doc_id is not null")
    total = known.agg(F.sum("n_shingles")).first()[0] or 0
    distinct = staged(known.groupBy("key").agg(F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n")), "distinct")
    # Two sieves leave the texts that can have a link: the second sees what passes the first, and few others.
    # Only their ids are written; texts are read again and do not move: what the filter of ids lets through in vain goes by its set's key.
    all_, chosen = texts.where("doc_id is not null"), distinct
    left = all_
    targets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), distinct.count() // TARGET_SETS + 1)
    for part_of in SIEVES:
        share = (100 - percent) / 100 + 1 / part_of
        buckets = max(1, int(total * share) // BUCKET_POSTINGS + 1)
        passed = shared_counts(left, width, percent, part_of, buckets, targets).join(chosen, "key").where(F.col("shared") >= F.floor(F.col("n") / part_of) + 1)
        chosen = staged(passed.select("key", "doc_id", "n"), "passed")
        total, count = chosen.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
        left = among(all_, chosen.select("doc_id"), count)

    def make(batches):
        for part in slices(batches, limit=SLICE):
            code, bounds, key = shingle_sets(part.column("text"), width)
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(code.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(key.astype(np.int64)), pa.array(np.diff(bounds)), lists], names=["doc_id", "key", "n", "tokens"])

    made = left.select("doc_id", "text").mapInArrow(make, "doc_id long, key long, n long, tokens array<bigint>")
    made = made.join(chosen.select("key", "doc_id"), ["key", "doc_id"], "left_semi").select("key", "n", "tokens")
    # Only rows of one id can bring a chosen set twice.
    repeated = not own.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty()
    sets = staged(made.dropDuplicates(["key"]) if repeated else made, "shingles")
    # Several sets of one id hang together by it; the first of them stands for all.
    groups = components(set_links(sets, percent).unionByName(_same_id(known)))
    labelled = staged(distinct.join(groups.withColumnRenamed("node", "key"), "key", "left").select("key", "doc_id", F.coalesce("component", "key").alias("component")), "labelled")
    firsts = staged(labelled.groupBy("component").agg(F.min("doc_id").alias("component_id")), "firsts")
    named = staged(labelled.join(firsts, "component").select("key", "component_id"), "named")
    rows = own.withColumn("key", F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("key")))
    # Rows without a set would all meet under a null key: they get keys of their own that nothing has.
    filled = rows.withColumn("has", F.col("key").isNotNull()).withColumn("key", F.coalesce("key", F.xxhash64("doc_id")))
    return filled.join(named.withColumn("has", F.lit(True)), ["key", "has"], "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _same_id(known: DataFrame) -> DataFrame:
    ids = known.groupBy("doc_id").agg(F.min("key").alias("a"), F.max("key").alias("b")).where("a <> b").select("doc_id", "a")
    return known.join(staged(ids, "ids"), "doc_id").where("key <> a").select("a", F.col("key").alias("b")).distinct()


def keep_first(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component: that of the smallest id. Rows of null id and repeated rows of that id stay."""
    found = jaccard_components(docs, width, percent)
    drop = staged(found.where("doc_id <> component_id").select("doc_id").distinct(), "copies")
    return docs.join(drop, "doc_id", "left_anti").select(*docs.columns)

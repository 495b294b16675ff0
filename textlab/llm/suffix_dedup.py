"""Removal of repeated byte strings: shards of suffixes that may agree, each sorted by a difference-cover algorithm."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.staging import set_aside, staged
from textlab.llm.words import BYTE_CODES, MULTIPLIER, mix, slices, text_bytes

LENGTH = 100               # bytes of a string that counts as repeated
GRAM = 32                  # bytes of an anchor; a power of two
PLACE_BITS = 28            # bits of a place inside a slice
DEPTH = 4                  # 3 ** (DEPTH + 1) bytes, more than LENGTH, decide the order of suffixes
SHARD_BYTES = 1 << 20      # most bytes that are sorted at once; symbols and ranks have 21 bits
SHARD_ANCHORS = 1 << 20    # anchors that one group of the first shuffle holds on average
SHARD_PIECES = 1 << 14     # pieces that one group of the second shuffle holds on average
HOT = 4000                 # anchors of more places are dealt by whole strings


def suffix_ranks(text: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Rank, from 1, of every suffix of ``text`` (symbols from 1 to below 2**21) by its first 3 ** (depth + 1) symbols or more.

    Suffixes at places 1 and 2 modulo 3 are the sample; their sorted triples name them. While names repeat and depth is
    left, the names of both kinds, one after the other, are ranked the same way. The other suffixes are sorted by their
    symbol and the rank after it, and merged: a key that it shares with a kind tells how many of that kind are before it.
    """
    n = len(text)
    s = np.concatenate([text.astype(np.int64), np.zeros(3, np.int64)])
    zeros, ones, twos = (np.arange(k, n, 3) for k in range(3))
    sample = np.concatenate([ones, twos])
    triples = (s[sample] << 42) | (s[sample + 1] << 21) | s[sample + 2]
    order = np.argsort(triples)
    names = np.empty(len(sample), np.int64)
    names[order] = np.cumsum(np.diff(triples[order], prepend=-1) != 0)
    if depth and len(names) and names.max() < len(names):
        ranks = suffix_ranks(np.concatenate([names[: len(ones)] + 1, [1], names[len(ones) :] + 1]), depth - 1)
        names = np.delete(ranks, len(ones))
        names -= names > ranks[len(ones)]
        order[names - 1] = np.arange(len(names))
    rank = np.zeros(n + 3, np.int64)
    rank[sample] = names
    one_key = lambda i: (s[i] << 21) | rank[i + 1]
    two_key = lambda i: (s[i] << 42) | (s[i + 1] << 21) | rank[i + 2]
    zeros = zeros[np.argsort(one_key(zeros))]
    before = np.searchsorted(np.sort(one_key(ones)), one_key(zeros)) + np.searchsorted(np.sort(two_key(twos)), two_key(zeros))
    place = np.maximum.accumulate(before) + np.arange(len(zeros))  # counts fall only among suffixes that agree further than asked
    free = np.ones(n, bool)
    free[place] = False
    out = np.empty(n, np.int64)
    out[zeros], out[sample[order]] = place + 1, np.flatnonzero(free) + 1
    return out


def repeated_starts(text: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which of ``starts`` begin a string of ``length`` bytes that also begins at a smaller one of them."""
    place = np.full(len(text), -1)
    place[starts] = np.arange(len(starts))
    order = np.empty(len(text), np.int64)
    order[suffix_ranks(text.astype(np.int64) + 1) - 1] = np.arange(len(text))
    order = order[place[order] >= 0]
    a, b = order[:-1], order[1:]
    same = np.ones(len(a), bool)
    for step in range(length):  # neighbours byte by byte; most differ soon
        at = np.flatnonzero(same)
        if not len(at):
            break
        same[at] = text[a[at] + step] == text[b[at] + step]
    group = np.concatenate([[0], np.cumsum(~same)]) if len(order) else np.zeros(0, np.int64)
    first = np.full(int(group[-1]) + 1 if len(group) else 0, len(text))
    np.minimum.at(first, group, order)
    out = np.zeros(len(starts), bool)
    out[place[order]] = first[group] < order
    return out


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Hash of the ``size`` bytes from every place on, by doubling; 0 beyond the last."""
    h, width, factor = BYTE_CODES[data], 1, MULTIPLIER
    while width < size:
        h = h[: len(h) - width] * factor + h[width:] if len(h) > width else h[:0]
        width, factor = width * 2, np.uint64(int(factor) ** 2 % (1 << 64))
    return mix(h)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """``row, place, hash, first, last``: every string of ``length`` bytes starts in [first, last] of one anchor.

    The anchor of a string is its leftmost gram of the smallest hash, so equal strings have equal anchors at equal distances. Places are in the row.
    """
    span = length - GRAM + 1
    grams = gram_hashes(data)
    size = np.diff(offsets)
    rows = np.flatnonzero(size >= length)
    empty = np.zeros(0, np.int64)
    if not len(rows) or len(data) >= 1 << PLACE_BITS:
        if len(rows):
            raise ValueError("a text is longer than 256 MB")
        return empty, empty, empty.astype(np.uint64), empty, empty
    packed = (grams >> np.uint64(PLACE_BITS) << np.uint64(PLACE_BITS)) | np.arange(len(grams), dtype=np.uint64)
    padded = np.concatenate([packed, np.full(-len(packed) % span + span, np.uint64(2**64 - 1))]).reshape(-1, span)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    counts = size[rows] - length + 1
    start = np.arange(int(counts.sum())) + np.repeat(offsets[rows] - (np.cumsum(counts) - counts), counts)
    least = (np.minimum(behind[start], ahead[start + span - 1]) & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
    change = np.flatnonzero(np.concatenate([[True], (least[1:] != least[:-1]) | (np.diff(start) != 1)]))
    last = start[np.append(change[1:], len(start)) - 1]
    place, first = least[change], start[change]
    row = np.searchsorted(offsets, first, "right") - 1
    return row, place - offsets[row], grams[place], first - offsets[row], last - offsets[row]


def _column(table, name: str, kind) -> np.ndarray:
    return np.concatenate([np.frombuffer(x.as_py(), kind) for x in table.column(name)] or [np.zeros(0, kind)])


def _packed(name: str, group: np.ndarray, columns: dict):
    """A batch for each group: its number as ``name``, and its values of each column in one binary cell."""
    order = np.argsort(group, kind="stable")
    ends = np.flatnonzero(np.diff(group[order], append=-1)) + 1 if len(group) else ()
    start = 0
    for end in ends:
        at = order[start:end]
        yield pa.RecordBatch.from_arrays([pa.array([int(group[at[0]])]), *[pa.array([x[at].tobytes()], pa.binary()) for x in columns.values()]], names=[name, *columns])
        start = end


def repeated_anchors(texts: DataFrame, buckets: int, targets: int, hot: int = HOT) -> DataFrame:
    """``h, places``: a row for each distinct text (by hash ``h``) with the places of anchors that occur elsewhere, in it or in another text; negative - 1 if hot.

    Anchors meet by their hash in ``buckets``; what repeats goes back packed, one row for each bucket and target, and is put together by text there.
    """

    def cut(batches):
        for batch in batches:
            batch = batch.take(np.unique(batch.column("h").to_numpy(), return_index=True)[1])  # copies bring the same places
            parts = []
            for part in slices([batch]):
                data, offsets = text_bytes(part.column("text"))
                row, place, code, _, _ = anchors(data, offsets)
                parts.append((code, part.column("h").to_numpy()[row], place))
            code, h, place = (np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, np.uint64),) * 3
            bucket = ((code >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)
            yield from _packed("bucket", bucket, {"code": code.astype("u8"), "h": h.astype("i8"), "place": place.astype("i4")})

    def meet(table):
        code, h, place = _column(table, "code", np.uint64), _column(table, "h", np.int64), _column(table, "place", np.int32)
        order = np.lexsort([place, h, code])
        code, h, place = code[order], h[order], place[order]
        fresh = np.ones(len(code), bool)  # copies of a text come with the same places
        fresh[1:] = (code[1:] != code[:-1]) | (h[1:] != h[:-1]) | (place[1:] != place[:-1])
        code, h, place = code[fresh], h[fresh], place[fresh].astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        counts = np.diff(np.append(starts, len(code)))
        own = np.repeat(counts, counts)
        place = np.where(own > hot, -1 - place, place)[own > 1]
        h = h[own > 1]
        target = (mix(h.view(np.uint64)) % np.uint64(targets)).astype(np.int64)
        rows = list(_packed("target", target, {"h": h, "place": place.astype("i4")}))
        return pa.Table.from_batches(rows, pa.schema([("target", pa.int64()), ("h", pa.binary()), ("place", pa.binary())]))

    def gather(table):
        h, place = _column(table, "h", np.int64), _column(table, "place", np.int32)
        order = np.argsort(h, kind="stable")
        own, first = np.unique(h[order], return_index=True)
        lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(h)), pa.int32()), pa.array(place[order], pa.int32()))
        return pa.table({"h": own, "places": lists})

    rows = texts.mapInArrow(cut, "bucket long, code binary, h binary, place binary")
    packed = rows.groupBy("bucket").applyInArrow(meet, "target long, h binary, place binary")
    return packed.groupBy("target").applyInArrow(gather, "h long, places array<int>")


def _shard_pieces(buckets: int, length: int):
    """Pieces of text around repeated anchors; a hot anchor's strings travel one by one, dealt by their own hash."""

    def cut(batches):
        for batch in batches:
            found = {}
            done = []
            for part in slices([batch]):
                data, offsets = text_bytes(part.column("text"))
                row, place, code, first, last = anchors(data, offsets)
                flat, edges = data.tobytes(), np.searchsorted(row, np.arange(part.num_rows + 1))
                names = list(zip(part.column("doc_id").to_pylist(), part.column("h").to_pylist()))
                for i, wanted in enumerate(part.column("places").to_pylist()):
                    own = slice(edges[i], edges[i + 1])
                    wanted = {p if p >= 0 else -1 - p: p < 0 for p in wanted}
                    for p, c, a, b in zip(place[own].tolist(), code[own].tolist(), first[own].tolist(), last[own].tolist()):
                        if p not in wanted:
                            continue
                        for x, y in [(a, b)] if not wanted[p] else [(x, x) for x in range(a, b + 1)]:
                            text = flat[offsets[i] + x : offsets[i] + y + length]
                            key = (text, x - p)
                            where = (*names[i], x, y)
                            if key in found and found[key][1] <= where:
                                if found[key][1] != where:  # a repeated row is no copy
                                    done.append(where)
                                continue
                            if key in found:
                                done.append(found[key][1])
                            shard = c if not wanted[p] else int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little")
                            found[key] = (shard, where)
            rows = {}
            for (text, _), (shard, where) in found.items():
                rows.setdefault((shard >> 20) % buckets, []).append((shard, text, where))
            for b, own in rows.items():
                yield _pieces_row(b, own, done)
                done = []
            if done:
                yield _pieces_row(0, [], done)

    return cut


def _pieces_row(bucket: int, own: list, done: list) -> pa.RecordBatch:
    number = lambda values, kind: np.array(values, kind).tobytes()
    fields = {"code": number([s for s, _, _ in own], "u8"), "text": b"".join(t for _, t, _ in own), "size": number([len(t) for _, t, _ in own], "i4")}
    for name, rows in (("", [w for _, _, w in own]), ("done_", done)):
        fields |= {name + k: number([w[i] for w in rows], kind) for i, (k, kind) in enumerate((("doc_id", "i8"), ("h", "i8"), ("first", "i4"), ("last", "i4")))}
    return pa.RecordBatch.from_arrays([pa.array([bucket]), *[pa.array([v], pa.binary()) for v in fields.values()]], names=["bucket", *fields])


PIECES = "bucket long, code binary, text binary, size binary, doc_id binary, h binary, first binary, last binary, done_doc_id binary, done_h binary, done_first binary, done_last binary"


def _joined(h: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> pa.Table:
    """Ranges of starts, those of a text whose strings overlap or touch made one."""
    order = np.lexsort([first, h])
    h, first, last = h[order].astype(np.int64), first[order].astype(np.int64), last[order].astype(np.int64)
    new = np.ones(len(h), bool)
    text = np.cumsum(np.diff(h, prepend=h[:1]) != 0) << 32  # a place has fewer bits, so the running maximum starts anew with each text
    reach = np.maximum.accumulate(text + last) - text if len(h) else last
    new[1:] = (h[1:] != h[:-1]) | (first[1:] > reach[:-1] + length)
    head = np.flatnonzero(new)
    return pa.table({"h": h[head], "first": first[head], "last": reach[np.append(head[1:], len(h)) - 1] if len(h) else last})


def _sort_shard(length: int):
    def meet(table):
        text, size, code = _column(table, "text", np.uint8), _column(table, "size", np.int32).astype(np.int64), _column(table, "code", np.uint64)
        doc, h = _column(table, "doc_id", np.int64), _column(table, "h", np.int64)
        first, last = _column(table, "first", np.int32).astype(np.int64), _column(table, "last", np.int32).astype(np.int64)
        out = [(_column(table, "done_h", np.int64), _column(table, "done_first", np.int32), _column(table, "done_last", np.int32))]
        begin = np.cumsum(size) - size
        # Equal pieces have the same anchor, so all of them are here: only the first one is sorted, the others are whole copies.
        flat, found, copies = text.tobytes(), {}, []
        for i, start, end in zip(*(x[np.lexsort([first, h, doc])].tolist() for x in (np.arange(len(size)), begin, begin + size))):
            j = found.setdefault(flat[start:end], i)
            if (first[j], h[j], doc[j]) != (first[i], h[i], doc[i]):  # a repeated row is no copy
                copies.append(i)
        out.append((h[copies], first[copies], last[copies]) if copies else (h[:0], first[:0], last[:0]))
        order = np.fromiter(found.values(), np.int64, len(found))
        del found
        # Equal strings lie equally far from their anchor, so an anchor with one piece left repeats nothing.
        _, group, counts = np.unique(code[order], return_inverse=True, return_counts=True)
        order = order[counts[group] > 1]
        order = order[np.argsort(code[order], kind="stable")]
        # Pieces of one anchor stay together; as many anchors as fit are sorted at once.
        ends = np.flatnonzero(np.concatenate([code[order][1:] != code[order][:-1], [True]])) + 1 if len(order) else np.zeros(0, np.int64)
        total, at = np.concatenate([[0], np.cumsum(size[order])]), 0
        while at < len(order):
            upto = ends[(ends > at) & (total[ends] - total[at] <= SHARD_BYTES)]
            end = int(upto[-1]) if len(upto) else int(ends[ends > at][0])
            own = order[at:end]
            own = own[np.lexsort([first[own], h[own], doc[own]])]
            at = end
            part = np.concatenate([text[begin[i] : begin[i] + size[i]] for i in own])
            counts = size[own] - length + 1
            base = np.cumsum(size[own]) - size[own]
            starts = np.arange(int(counts.sum())) + np.repeat(base - (np.cumsum(counts) - counts), counts)
            repeated = np.flatnonzero(repeated_starts(part, starts, length))
            piece = np.repeat(np.arange(len(own)), counts)[repeated]
            place = first[own][piece] + starts[repeated] - base[piece]
            new = np.concatenate([[True], (np.diff(place) != 1) | (np.diff(piece) != 0)]) if len(place) else np.zeros(0, bool)
            head = np.flatnonzero(new)
            tail = np.append(head[1:], len(place)) - 1 if len(head) else head
            out.append((h[own][piece[head]], place[head], place[tail]))
        return _joined(*(np.concatenate([x[i] for x in out]) for i in range(3)), length)

    return meet


def remove_repeats(docs: DataFrame, length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """Every row of ``docs`` with ``kept`` (binary, the bytes that stay), ``n_bytes``, ``n_removed`` and ``n_spans``.

    A byte goes if a string of ``length`` bytes over it also starts earlier: in a document of a smaller id, or before in the same document.
    Documents of one id are ordered by the hash of their text, those without an id come first; repeated rows are one document and have one result.
    Null and empty texts keep nothing; a text of 256 MB or more is refused. Columns named like a result are replaced, others stay.

    Any two equal strings have the same anchor, so only pieces of text around anchors that occur twice are sorted, and pieces of one anchor meet in one shard,
    where equal ones are sorted once.
    """
    names = ("kept", "n_bytes", "n_removed", "n_spans")
    docs, own_names = set_aside(docs.drop(*names).withColumn("text", F.col("text").cast("string")), ("h", "own_id", "first_id", "ranges"))
    keyed = docs.withColumn("h", F.xxhash64("text"))
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    texts = keyed.where(F.octet_length("text") >= length).select(own.alias("doc_id"), "h", "text")
    # Of equal texts only that of the smallest id can keep a byte: the others are whole copies.
    firsts = staged(texts.groupBy("h").agg(F.min("doc_id").alias("first_id"), F.sum(F.octet_length("text")).alias("n")), "firsts")
    total = firsts.agg(F.sum("n")).first()[0] or 0
    buckets = int(total * 2 / (length - GRAM + 2)) // SHARD_ANCHORS + 1
    targets = max(buckets, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    wanted = staged(repeated_anchors(texts.select("h", "text"), buckets, targets, hot), "wanted")
    pieces = (wanted.agg(F.sum(F.size("places"))).first()[0] or 0) // SHARD_PIECES + 1
    around = texts.join(wanted.join(firsts.select("h", F.col("first_id").alias("doc_id")), "h"), ["h", "doc_id"])
    rows = around.select("doc_id", "h", "text", "places").mapInArrow(_shard_pieces(int(pieces), length), PIECES)
    ranges = staged(rows.groupBy("bucket").applyInArrow(_sort_shard(length), "h long, first long, last long"), "ranges")
    spans = staged(ranges.groupBy("h").agg(F.collect_list(F.struct("first", "last")).alias("ranges")), "spans")
    marks = staged(firsts.select("h", "first_id").join(spans, "h", "left"), "marks")
    joined = keyed.withColumn("own_id", own).join(marks, "h", "left")
    schema = docs.withColumn("kept", F.lit(b"")).withColumn("n_bytes", F.lit(0).cast("long")).withColumn("n_removed", F.lit(0).cast("long")).withColumn("n_spans", F.lit(0).cast("long")).schema
    columns = docs.columns

    def cut(batches):
        for batch in batches:
            for part in slices([batch]):
                out = []
                for text, ident, first, ranges in zip(*(part.column(c).to_pylist() for c in ("text", "own_id", "first_id", "ranges"))):
                    raw = (text or "").encode()
                    gone = np.zeros(len(raw) + 1, np.int64)
                    if first is not None and ident > first:
                        gone[0], gone[-1] = 1, -1
                    for r in ranges or ():
                        gone[r["first"]] += 1
                        gone[r["last"] + length] -= 1
                    gone = np.cumsum(gone)[:-1] > 0
                    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                    out.append({"kept": kept, "n_bytes": len(raw), "n_removed": int(gone.sum()), "n_spans": int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum())})
                added = pa.array(out, pa.struct([("kept", pa.binary()), *[(n, pa.int64()) for n in names[1:]]])).flatten()
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in columns], *added], names=[*columns, *names])

    return joined.select(*columns, "own_id", "first_id", "ranges").mapInArrow(cut, schema).select(*own_names, *names)

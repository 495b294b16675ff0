"""SentencePiece encoding by unigram Viterbi over a double-array trie, and decoding."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlab.llm.segments import SegmentCache
from textlab.llm.words import mix, slices, text_bytes, words_of_bytes

MARKER = "▁"
UNKNOWN_PENALTY = 10.0   # of a character without a piece, below the lowest score
SPACE = 32
NOT_BLANK = np.arange(256) != SPACE
CELLS = 1 << 20           # segments x bytes that are solved at once


@dataclass
class Model:
    base: np.ndarray         # double-array trie over bytes: child of s by byte c is t = base[s] + c if check[t] == s
    check: np.ndarray
    piece: np.ndarray        # id of the piece that ends in a state, or -1
    score: np.ndarray        # log score by id
    unknown: float           # log score of a character without a piece
    byte_id: np.ndarray      # id of each byte
    start: np.ndarray        # bytes of each id: decoded[start[id]:start[id + 1]]
    decoded: np.ndarray
    by_word: bool            # no piece goes on after a blank that follows something else


def double_array(keys: list[tuple[bytes, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base, check and value arrays of ``keys`` (bytes, value); state 0 is the root."""
    root: dict = {}
    for key, value in keys:
        node = root
        for c in key:
            node = node.setdefault(c, {})
        node[-1] = value
    size = 1 << 12
    base, check, value = np.zeros(size, np.int64), np.full(size, -1, np.int64), np.full(size, -1, np.int64)
    check[0], low, queue = 0, 1, [(0, root)]
    while queue:
        state, node = queue.pop()
        value[state] = node.get(-1, -1)
        codes = np.array(sorted(c for c in node if c >= 0), np.int64)
        if not len(codes):
            continue
        at, found = max(1, low - int(codes[0])), False
        while not found:  # the first place where all children are free, 4096 places at a time
            if at + 4096 + 256 > len(base):
                grown = len(base) + 8192
                base, check, value = (np.concatenate([x, np.full(grown, fill, np.int64)]) for x, fill in ((base, 0), (check, -1), (value, -1)))
            free = np.ones(4096, bool)
            for c in codes:
                free &= check[at + c : at + c + 4096] < 0
            found = bool(free.any())
            at += int(free.argmax()) if found else 4096
        if len(codes) == 1:
            low = max(low, at + int(codes[0]))
        base[state] = at
        check[at + codes] = state
        queue += [(int(at + c), node[int(c)]) for c in codes]
    return base, check, value


def load(path: str) -> Model:
    """The pieces of a SentencePiece model file.

    Scores of a unigram model are log probabilities and used as they are. The scores of a merge model are
    ranks (0, -1, -2, ...): rank r counts as -log(1 + r), its log probability under Zipf's law but for a constant.
    Nothing is trained. The model has to hold a piece for each byte.
    """
    import sentencepiece

    source = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(source.get_piece_size())
    raw = np.array([source.get_score(i) for i in ids], np.float64)
    text = [source.id_to_piece(i) for i in ids]
    normal = [i for i in ids if not (source.is_byte(i) or source.is_control(i) or source.is_unknown(i) or source.is_unused(i))]
    ranks = len(normal) and raw[normal].min() < -1000
    score = -np.log1p(np.maximum(-raw, 0)) if ranks else raw
    byte_id = np.full(256, -1)
    for i in ids:
        if source.is_byte(i):
            byte_id[int(text[i][3:5], 16)] = i
    if (byte_id < 0).any():
        raise ValueError("the model has no byte fallback")
    return build({i: text[i].replace(MARKER, " ").encode() for i in normal}, score, byte_id)


def build(pieces: dict[int, bytes], score: np.ndarray, byte_id: np.ndarray) -> Model:
    """A model of ``pieces`` (id to bytes, the blank as a space); ``score`` by id; other ids decode to nothing."""
    decoded = [pieces.get(i, b"") for i in range(len(score))]
    for value, i in enumerate(byte_id):
        decoded[i] = bytes([value])
    start = np.concatenate([[0], np.cumsum([len(d) for d in decoded])])
    by_word = not any(b" " in p.lstrip(b" ") for p in pieces.values())
    lowest = min((score[i] for i in pieces), default=0.0)
    trie = double_array(sorted((p, i) for i, p in pieces.items() if p))
    return Model(*trie, np.asarray(score, np.float64), float(lowest) - UNKNOWN_PENALTY, byte_id, start,
                 np.frombuffer(b"".join(decoded), np.uint8), by_word)


def _character_bytes(lead: np.ndarray) -> np.ndarray:
    return 1 + (lead >= 0xC0).astype(np.int64) + (lead >= 0xE0) + (lead >= 0xF0)


def viterbi(model: Model, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the best segmentation of every segment, and bounds of each segment's ids.

    All segments advance byte by byte together. Of equal sums the piece that starts first, so the longest last one, stays.
    """
    order = np.argsort(size, kind="stable")
    rows_out, step_out, ids_out, at = [], [], [], 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (end - at + 1) * (size[order[min(end + 1023, len(order) - 1)]] + 1) <= CELLS:
            end = min(end + 1024, len(order))
        group = order[at:end]
        at = end
        for r, s, i in _solve(model, data, start[group], size[group]):
            rows_out.append(group[r]), step_out.append(s), ids_out.append(i)
    if not rows_out:
        return np.zeros(0, np.int64), np.zeros(len(size) + 1, np.int64)
    rows = np.concatenate(rows_out)
    steps = np.concatenate([np.full(len(i), s) for s, i in zip(step_out, ids_out)])
    sorting = np.lexsort([-steps, rows])
    return np.concatenate(ids_out)[sorting], np.searchsorted(rows[sorting], np.arange(len(size) + 1))


def _solve(model: Model, data, start, size):
    n, longest = len(size), int(size.max())
    best = np.full((n, longest + 1), -np.inf)
    back, piece = np.zeros((n, longest + 1), np.int32), np.full((n, longest + 1), -1, np.int32)
    best[:, 0] = 0.0
    base, check, ends, limit = model.base, model.check, model.piece, len(model.check)
    for i in range(longest):
        rows = np.flatnonzero((size > i) & (best[:, i] > -np.inf))
        if not len(rows):
            continue
        lead = best[rows, i]
        width = np.minimum(_character_bytes(data[start[rows] + i]), size[rows] - i)
        single = np.zeros(len(rows), bool)
        live, state, k = np.arange(len(rows)), np.zeros(len(rows), np.int64), i
        while len(live):
            live, state = live[size[rows[live]] > k], state[size[rows[live]] > k]
            target = np.minimum(base[state] + data[start[rows[live]] + k], limit - 1)
            ok = (check[target] == state) & (target > 0) & (base[state] > 0)
            live, state, k = live[ok], target[ok], k + 1
            found = ends[state] >= 0
            if found.any():
                own, ids = live[found], ends[state[found]]
                single[own] |= k - i == width[own]
                total, r = lead[own] + model.score[ids], rows[own]
                better = total > best[r, k]
                best[r[better], k], back[r[better], k], piece[r[better], k] = total[better], i, ids[better]
        alone = np.flatnonzero(~single)
        r, k = rows[alone], i + width[alone]
        total = lead[alone] + model.unknown
        better = total > best[r, k]
        best[r[better], k[better]], back[r[better], k[better]], piece[r[better], k[better]] = total[better], i, -1
    rows, place = np.arange(n), size.astype(np.int64)
    until, step = np.full(n, -1), 0  # inside a character without a piece: its first byte
    while True:
        live = rows[place[rows] > 0]
        if not len(live):
            return
        rows = live
        p = place[rows]
        fresh = until[rows] < 0
        ids = piece[rows, p].astype(np.int64)
        until[rows[fresh & (ids < 0)]] = back[rows, p][fresh & (ids < 0)]
        inside = until[rows] >= 0
        ids[inside] = model.byte_id[data[start[rows[inside]] + p[inside] - 1]]
        yield rows, step, ids
        place[rows] = np.where(inside, p - 1, back[rows, p])
        left = rows[inside & (place[rows] == until[rows])]
        until[left] = -1
        step += 1


class Encoder:
    """Encodes slices of texts; segments that were met before are looked up by hash."""

    def __init__(self, model: Model):
        self.model, self.cache = model, SegmentCache()

    def segments(self, column: pa.Array):
        """Texts with a space before each that is not empty: bytes, and row, start, size and hash of each segment."""
        raw, offsets = text_bytes(column)
        size = np.diff(offsets)
        moved = np.cumsum(np.concatenate([[0], size + (size > 0)]))
        data = np.full(moved[-1], SPACE, np.uint8)
        data[np.arange(len(raw)) + np.repeat((moved[:-1] + (size > 0)) - offsets[:-1], size)] = raw
        if not self.model.by_word:
            rows = np.flatnonzero(size)
            return data, rows, moved[rows], (moved[1:] - moved[:-1])[rows], None
        found = words_of_bytes(data, moved, NOT_BLANK)
        # A segment is a run of blanks and the word after it; blanks at a row's end are one more.
        last = moved[:-1].copy()
        np.maximum.at(last, found.doc, found.end)
        tails = np.flatnonzero(last < moved[1:])
        before = np.concatenate([[0], found.end[:-1]]) if len(found.end) else found.end
        before = np.maximum(before, moved[found.doc])
        rows = np.concatenate([found.doc, tails])
        start = np.concatenate([before, last[tails]])
        end = np.concatenate([found.end, moved[tails + 1]])
        code = mix(np.concatenate([found.hash, np.zeros(len(tails), np.uint64)])) + (np.concatenate([found.start, moved[tails + 1]]) - start).astype(np.uint64)
        order = np.argsort(start, kind="stable")
        return data, rows[order], start[order], (end - start)[order], mix(code[order])

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, and bounds of each row's ids."""
        data, rows, start, size, code = self.segments(column)
        if code is None:
            ids, bounds = viterbi(self.model, data, start, size)
            counts = np.diff(bounds)
        else:
            ids, counts = self.cache.encode(code, lambda first: viterbi(self.model, data, start[first], size[first]))
        total = np.concatenate([[0], np.cumsum(counts)])
        return ids, total[np.searchsorted(rows, np.arange(len(column) + 1))]


def decode_bytes(model: Model, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """The bytes of each row of ids, markers as spaces, without the space before the text."""
    size = model.start[ids + 1] - model.start[ids]
    total = np.concatenate([[0], np.cumsum(size)])
    flat = model.decoded[np.arange(total[-1]) + np.repeat(model.start[ids] - total[:-1], size)].tobytes()
    edges = total[bounds]
    return [flat[a + flat.startswith(b" ", a, b) : b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]


def encode(docs: DataFrame, model: Model, column: str = "text", decoded: str | None = None) -> DataFrame:
    """Every row of ``docs`` with ``ids``, the pieces of its whole text, and, where asked for, in ``decoded`` what they stand for.

    A space goes before the text and each space is the marker; nothing else is normalised. Null and empty texts have
    no ids. A character without a piece becomes its UTF-8 bytes; so does a marker character in a text, which keeps
    decoding exact. A row whose segments do not decode to its text (two segments with one hash) is solved anew by itself.
    A column named like a result is replaced; other columns and repeated rows stay.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("ids", *([decoded] if decoded else [])).withColumn(column, F.col(f"`{column}`").cast("string"))

    def run(batches):
        encoder = Encoder(shipped.value)
        for part in slices(batches, column, 1 << 21):
            ids, bounds = encoder.encode(part.column(column))
            raw, offsets = text_bytes(part.column(column))
            lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32()))
            flat = raw.tobytes()
            back = decode_bytes(encoder.model, ids, bounds)
            wrong = [i for i, text in enumerate(back) if text != flat[offsets[i] : offsets[i + 1]]]
            if wrong:
                rows = lists.to_pylist()
                for i in wrong:
                    own, ends = Encoder(encoder.model).encode(part.column(column).slice(i, 1))
                    rows[i], back[i] = own.tolist(), decode_bytes(encoder.model, own, ends)[0]
                lists = pa.array(rows, pa.list_(pa.int32()))
            coded = part.append_column("ids", lists)
            yield coded.append_column(decoded, pa.array([t.decode("utf-8", "replace") for t in back], pa.string())) if decoded else coded

    made = docs.withColumn("ids", F.lit(None).cast("array<int>"))
    return docs.mapInArrow(run, (made.withColumn(decoded, F.lit("")) if decoded else made).schema)


def decode(docs: DataFrame, model: Model, column: str = "ids", into: str = "decoded") -> DataFrame:
    """Every row with the text of its ids; null ids are empty, ids outside the model fail, broken UTF-8 is replaced."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(into)

    def run(batches):
        for batch in batches:
            for at in range(0, max(batch.num_rows, 1), 500):
                part = batch.slice(at, 500)
                lists = part.column(column).fill_null([])
                ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                bounds = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
                if len(ids) and (ids.min() < 0 or ids.max() >= len(shipped.value.score)):
                    raise ValueError("an id is not in the model")
                texts = [t.decode("utf-8", "replace") for t in decode_bytes(shipped.value, ids, bounds)]
                yield part.append_column(into, pa.array(texts, pa.string()))

    return docs.mapInArrow(run, docs.withColumn(into, F.lit("")).schema)

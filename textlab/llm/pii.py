"""Personal data: fixed patterns, and a semi-Markov conditional random field that adds spans they miss."""

from __future__ import annotations

import math
import re
from collections import OrderedDict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


KINDS = ("email", "ip", "card", "phone")
LOCAL = "A-Za-z0-9._%+-"
# The patterns of the contract. Possessive repeats and the look-behind only spare starts inside a run that must fail as its first did.
_EMAIL = rf"[{LOCAL}]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
EMAIL_ANYWHERE, EMAIL_AT_RUN = re.compile(_EMAIL), re.compile(rf"(?<![{LOCAL}]){_EMAIL}")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

LONGEST = 12              # tokens of a span that the model considers
SAMPLE_DOCS = 3000        # documents from which training windows are taken
SAMPLE_WINDOWS = 1500     # windows that the model is fitted on
EPOCHS, RATE, PENALTY = 12, 0.3, 1e-3
CUES = {  # words before a span that hint at its kind
    "mail": "email", "email": "email", "ip": "ip", "host": "ip", "card": "card", "visa": "card", "phone": "phone", "tel": "phone", "call": "phone",
}
ANCHOR = re.compile(r"[0-9@]+")
TOKEN = re.compile(r"[^\W\d_]+|[0-9]+|\S")
CACHE = 20_000


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points of what the patterns find: leftmost, non-overlapping within a kind."""
    out = []
    if "@" in text:
        at = 0
        while found := (EMAIL_ANYWHERE.match(text, at) if at else None) or EMAIL_AT_RUN.search(text, at):
            out.append((0, found.start(), found.end()))
            at = found.end()
    if "." in text:
        for found in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in found.group().split(".")):
                out.append((1, *found.span()))
    for found in CARD.finditer(text):
        if found.end() - found.start() >= 13:
            digits = digits_of(found.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *found.span()))
    if "+" in text:
        for found in PHONE.finditer(text):
            if 9 <= len(digits_of(found.group())) <= 15:
                out.append((3, *found.span()))
    return out


def windows(text: str):
    """(start, end) of stretches around digits and ``@`` that lie close together on a line, with the words around them."""
    first = last = -1
    for found in ANCHOR.finditer(text):
        start, end = found.span()
        if first >= 0 and start - last <= 12 and "\n" not in text[last:start]:
            last = end
            continue
        if first >= 0:
            yield _around(text, first, last)
        first, last = start, end
    if first >= 0:
        yield _around(text, first, last)


def _around(text: str, start: int, end: int) -> tuple[int, int]:
    before, after = text[max(0, start - 40) : start], text[end : end + 40]
    before, after = before[before.rfind("\n") + 1 :], after.partition("\n")[0]
    words = [m.start() for m in re.finditer(r"\S+", before)]
    if words:
        start -= len(before) - words[max(0, len(words) - 2)]
    words = [m.end() for m in re.finditer(r"\S+", after)]
    if words:
        end += words[min(1, len(words) - 1)]
    return start, end


def tokens_of(text: str, start: int, end: int) -> list[tuple[str, int, int, bool]]:
    """(token, start, end, after a gap) of a window."""
    out, last = [], start
    for found in TOKEN.finditer(text, start, end):
        out.append((found.group(), found.start(), found.end(), found.start() > last))
        last = found.end()
    return out


def signature(tokens) -> tuple:
    """All that features see of a window: words only by cue, digits by number and value below 256, or whole where cards fit."""
    long = sum(len(t) for t, _, _, _ in tokens if "0" <= t[0] <= "9") >= 13
    out = []
    for token, _, _, gap in tokens:
        if "0" <= token[0] <= "9":
            out.append(("9", token if long and len(token) < 20 else len(token), len(token) <= 3 and int(token) <= 255, gap))
        elif token[0].isalpha():
            out.append(("a", CUES.get(token.lower(), ""), False, gap))
        else:
            out.append((token, 0, False, gap))
    return tuple(out)


def span_features(sig: tuple, i: int, j: int) -> list[str] | None:
    """Features of tokens i to j as one span; None where a span cannot be: no digit or ``@``, or an end that is loose punctuation."""
    part = sig[i:j]
    numbers = [s for s in part if s[0] == "9"]
    at = any(s[0] == "@" for s in part)
    if not (numbers or at) or part[0][0] not in ("9", "a", "+", "(") or part[-1][0] not in ("9", "a"):
        return None
    size = [len(s[1]) if isinstance(s[1], str) else s[1] for s in numbers]
    total, letters = sum(size), any(s[0] == "a" for s in part)
    gaps = sum(s[3] for s in part[1:])
    marks = "".join(s[0] for s in part if s[0] not in "9a")
    shape = "".join((" " if k and s[3] else "") + (f"<{len(s[1]) if isinstance(s[1], str) else s[1]}>" if s[0] == "9" and not letters else s[0]) for k, s in enumerate(part))
    out = ["bias", f"digits{min(total, 20)}", f"gaps{min(gaps, 5)}", f"marks{marks[:8]}", f"first{part[0][0]}", f"letters{letters}{at}"]
    if not letters:
        out.append(f"shape{shape[:40]}")
    else:
        out.append(f"dots{min(marks.count('.'), 3)}{at}{gaps > 0}")
        if at:
            tail = marks[marks.index("@") + 1 :]
            out.append(f"host{set(tail) <= set('.-') and '.' in tail}{gaps == 0}")
    if len(numbers) == 4 and marks == "..." and not letters:
        out.append(f"octets{all(s[2] for s in numbers)}{gaps == 0}")
    if 13 <= total <= 19 and not letters and all(isinstance(s[1], str) for s in numbers):
        out.append(f"luhn{luhn(''.join(s[1] for s in numbers))}{set(marks) <= {'-'}}")
    before, after = sig[i - 1] if i else None, sig[j] if j < len(sig) else None
    if before and not part[0][3]:
        out.append(f"before{before[0]}")
    if after and not after[3]:
        out.append(f"after{after[0]}{j + 1 < len(sig) and not sig[j + 1][3] and sig[j + 1][0] in ('9', 'a')}")
    for back in sig[max(0, i - 2) : i]:
        if back[0] == "a" and back[1]:
            out.append(f"cue{back[1]}")
    return out


def lattice(sig: tuple) -> list[tuple[int, int, list[str]]]:
    return [(i, j, f) for j in range(1, len(sig) + 1) for i in range(max(0, j - LONGEST), j) if (f := span_features(sig, i, j))]


def _log_sum(values) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values)) if top > -math.inf else top


class SemiMarkov:
    """Scores of spans by kind; a token outside every span scores 0."""

    def __init__(self, features: dict[str, int], weights: np.ndarray):
        self.features, self.weights, self.cache = features, weights, OrderedDict()

    def scores(self, spans) -> np.ndarray:
        if not spans:
            return np.zeros((0, len(KINDS)))
        ids = [[self.features[f] for f in fs if f in self.features] for _, _, fs in spans]
        flat = np.array([x for row in ids for x in [len(self.weights) - 1, *row]])  # the last weight stays 0
        starts = np.cumsum([0, *[len(row) + 1 for row in ids[:-1]]])
        return np.add.reduceat(self.weights[flat], starts)

    def decode(self, sig: tuple) -> list[tuple[int, int, int]]:
        """The best set of disjoint spans (kind, first token, end): dynamic programming over boundaries and kinds together."""
        if sig in self.cache:
            self.cache.move_to_end(sig)
            return self.cache[sig]
        spans = lattice(sig)
        score = self.scores(spans)
        ending: dict = {}
        for (i, j, _), row in zip(spans, score):
            ending.setdefault(j, []).append((i, int(row.argmax()), float(row.max())))
        best, back = [0.0] * (len(sig) + 1), [None] * (len(sig) + 1)
        for j in range(1, len(sig) + 1):
            best[j] = best[j - 1]
            for i, kind, s in ending.get(j, ()):
                if best[i] + s > best[j]:
                    best[j], back[j] = best[i] + s, (kind, i, j)
        out, j = [], len(sig)
        while j:
            if back[j]:
                out.append(back[j])
            j = back[j][1] if back[j] else j - 1
        self.cache[sig] = out[::-1]
        if len(self.cache) > CACHE:
            self.cache.popitem(last=False)
        return out[::-1]


def fit(examples: list[tuple[tuple, list[tuple[int, int, int]]]]) -> SemiMarkov:
    """Conditional likelihood of the gold spans by forward and backward sums over all segmentations; AdaGrad, fixed order."""
    prepared, features = [], {}
    for sig, gold in examples:
        spans = lattice(sig)
        ids = [[features.setdefault(f, len(features)) for f in fs] for _, _, fs in spans]
        place = {(i, j): n for n, (i, j, _) in enumerate(spans)}
        known = [(place[i, j], kind) for kind, i, j in gold if (i, j) in place]
        if spans and len(known) == len(gold):
            flat = np.array([x for row in ids for x in row])
            prepared.append((len(sig), [(i, j) for i, j, _ in spans], flat, np.cumsum([0, *map(len, ids[:-1])]), np.repeat(np.arange(len(ids)), [len(r) for r in ids]), known))
    weights = np.zeros((len(features) + 1, len(KINDS)))
    squares = np.full_like(weights, 1e-6)
    for _ in range(EPOCHS):
        for n, spans, flat, starts, owner, known in prepared:
            score = np.add.reduceat(weights[flat], starts)
            whole = np.log(np.exp(score - score.max(axis=1, keepdims=True)).sum(axis=1)) + score.max(axis=1)
            ending, begun = [[] for _ in range(n + 1)], [[] for _ in range(n + 1)]
            for k, (i, j) in enumerate(spans):
                ending[j].append((i, k))
                begun[i].append((j, k))
            ahead, behind = [0.0] * (n + 1), [0.0] * (n + 1)
            for j in range(1, n + 1):
                ahead[j] = _log_sum([ahead[j - 1], *[ahead[i] + whole[k] for i, k in ending[j]]])
            for i in range(n - 1, -1, -1):
                behind[i] = _log_sum([behind[i + 1], *[behind[j] + whole[k] for j, k in begun[i]]])
            ends = np.array([[ahead[i], behind[j]] for i, j in spans])
            gradient = -np.exp(np.minimum(score + (ends.sum(axis=1) - ahead[n])[:, None], 0))
            for k, kind in known:
                gradient[k, kind] += 1
            used, inverse = np.unique(flat, return_inverse=True)
            step = np.zeros((len(used), len(KINDS)))
            np.add.at(step, inverse, gradient[owner])
            step -= PENALTY * weights[used]
            squares[used] += step**2
            weights[used] += RATE * step / np.sqrt(squares[used])
    weights[-1] = 0
    return SemiMarkov(features, weights)


def variants(kind: int, text: str) -> list[str]:
    """Other spellings of a span that the patterns do not match."""
    digits = digits_of(text)
    if kind == 0:
        return [text.replace("@", " @ ")]
    if kind == 1:
        return [text.replace(".", "[.]")]
    if kind == 2:
        return [".".join(digits[i : i + 4] for i in range(0, len(digits), 4))]
    return [f"({digits[-10:-7]}) {digits[-7:-4]}-{digits[-4:]}", f"{digits[-10:-7]}-{digits[-7:-4]}-{digits[-4:]}"] if len(digits) >= 10 else []


def gold(tokens, spans) -> list[tuple[int, int, int]] | None:
    """Spans in tokens; None where one cuts a token or two overlap."""
    first, last = {t[1]: n for n, t in enumerate(tokens)}, {t[2]: n + 1 for n, t in enumerate(tokens)}
    out, free = [], 0
    for kind, start, end in sorted(spans, key=lambda s: s[1]):
        if start not in first or end not in last or first[start] < free:
            return None
        out.append((kind, first[start], last[end]))
        free = last[end]
    return out


def examples_of(text: str):
    """Training windows of a text as (window, flat spans): as they are, and with a span in another spelling."""
    base = base_spans(text)
    for start, end in windows(text):
        inside = [(k, a - start, b - start) for k, a, b in base if a >= start and b <= end]
        if any(a < end and b > start and not (a >= start and b <= end) for _, a, b in base):
            continue
        window = text[start:end]
        yield window, inside
        if len(inside) == 1:
            kind, a, b = inside[0]
            for other in variants(kind, window[a:b]):
                yield window[:a] + other + window[b:], [(kind, a, a + len(other))]


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_windows: int = SAMPLE_WINDOWS) -> SemiMarkov:
    """A model fitted on windows of at most about ``sample_docs`` documents, at most ``sample_windows`` of them.

    There are no labels of personal data: what the patterns find is the label, and respelt copies of it teach
    what they miss. The windows are short and bounded in number, so they are fitted on the driver. Without any
    window the model adds nothing.
    """
    share = min(1.0, sample_docs / max(docs.count(), 1))
    chosen = docs.where(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select(F.col("text").cast("string").alias("text"))

    def extract(batches):
        for batch in batches:
            rows = [{"window": w, "spans": [{"k": k, "a": a, "b": b} for k, a, b in s]} for text in batch.column("text") for w, s in examples_of(text.as_py() or "") if len(w) <= 400]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("window", pa.string()), ("spans", pa.list_(pa.struct([("k", pa.int32()), ("a", pa.int32()), ("b", pa.int32())])))]))

    found = chosen.mapInArrow(extract, "window string, spans array<struct<k:int,a:int,b:int>>")
    rows = found.dropDuplicates(["window"]).orderBy(F.xxhash64("window"), "window").limit(sample_windows).collect()
    examples = []
    for row in rows:
        tokens = tokens_of(row["window"], 0, len(row["window"]))
        marked = gold(tokens, [(s["k"], s["a"], s["b"]) for s in row["spans"]])
        if marked is not None:
            examples.append((signature(tokens), marked))
    return fit(examples)


def added_spans(model: SemiMarkov, text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The model's spans that touch none of ``base``."""
    out = []
    for start, end in windows(text):
        if any(a <= start and b >= end for _, a, b in base):
            continue
        tokens = tokens_of(text, start, end)
        for kind, i, j in model.decode(signature(tokens)):
            a, b = tokens[i][1], tokens[j - 1][2]
            if not any(x < b and y > a for _, x, y in base):
                out.append((kind, a, b))
    return out


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])


def _few(batches):
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            yield batch.slice(at, 500)


def _searched(model: SemiMarkov, text: str) -> tuple[list, list]:
    """Spans of the patterns, and those with what the model adds."""
    known = base_spans(text)
    return known, known + added_spans(model, text, known)


def find_pii(docs: DataFrame, model: SemiMarkov) -> DataFrame:
    """Every row of ``docs`` with ``base`` and ``spans``: arrays of (kind, start, end) in code points, ordered by kind, then start.

    ``base`` is what the patterns find in the whole text, ``spans`` that and what the model adds. Null and empty texts have none.
    Repeated rows are searched each; columns named like a result are replaced, others stay.
    """
    docs = docs.drop("base", "spans").withColumn("text", F.col("text").cast("string"))
    features, weights = model.features, model.weights
    shipped = docs.sparkSession.sparkContext.broadcast((features, weights))
    kind = "array<struct<kind:string,start:long,end:long>>"

    def run(batches):
        own = SemiMarkov(*shipped.value)
        for part in _few(batches):
            found = [_searched(own, text.as_py() or "") for text in part.column("text")]
            columns = [pa.array([[{"kind": KINDS[k], "start": a, "end": b} for k, a, b in sorted(pair[i])] for pair in found], pa.list_(SPAN)) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=[*part.schema.names, "base", "spans"])

    return docs.mapInArrow(run, docs.withColumn("base", F.lit(None).cast(kind)).withColumn("spans", F.lit(None).cast(kind)).schema)


def redact(docs: DataFrame, model: SemiMarkov) -> DataFrame:
    """``docs`` with every span of a text replaced by its kind in brackets; spans that overlap become one, named after the first. All columns stay."""
    docs = docs.withColumn("text", F.col("text").cast("string"))
    shipped = docs.sparkSession.sparkContext.broadcast((model.features, model.weights))

    def masked(own: SemiMarkov, text: str) -> str:
        parts, at = [], 0
        for kind, start, end in sorted(_searched(own, text)[1], key=lambda s: (s[1], -s[2], s[0])):
            if start >= at:
                parts += [text[at:start], f"[{KINDS[kind].upper()}]"]
            at = max(at, end)
        return "".join([*parts, text[at:]])

    def run(batches):
        own = SemiMarkov(*shipped.value)
        for part in _few(batches):
            texts = [None if text is None else masked(own, text) for text in part.column("text").to_pylist()]
            yield part.set_column(part.schema.get_field_index("text"), "text", pa.array(texts, pa.string()))

    return docs.mapInArrow(run, docs.schema)

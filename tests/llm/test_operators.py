"""Small tables with nulls, empty and repeated rows, extra columns: operators against brute force."""

import gzip
import random
import re
import zlib
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest

from textlab.llm import decontamination, embedding_links, jaccard_join, pii, token_files, toxicity, url_filters, warc

EXTRA = ", n_hit long, spans string"


def smallest_reachable(nodes, edges):
    found = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(found[a], found[b])
            if found[a] != low or found[b] != low:
                found[a] = found[b] = low
                changed = True
    return found


# Decontamination

ITEMS = [("a", "One two three four five six seven eight nine ten eleven"), ("b", "short item"), ("c", None), ("d", ""), ("e", "SHORT, item!"), (None, "never seen words")]
DOCS = [
    (1, "x one two THREE four five six, seven eight nine ten y", 9, "s"), (2, "a short item here; a short item", 9, None), (3, None, None, "s"),
    (4, "", 1, "s"), (5, "one two three four five six seven eight nine", 1, "s"), (6, "é " * 5000 + "short item", 1, "s"), (None, "short item", 1, "s"), (1, "clean", 1, "s"),
]


def brute_hits(text):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    own, hit, items = words(text), set(), set()
    for item, t in ITEMS:
        w = words(t)
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            for i in range(len(own) - n + 1):
                if own[i : i + n] == w[k : k + n]:
                    hit.update(range(i, i + n))
                    items.add(item)
    return len(own), len(hit), sorted(i for i in items if i is not None)


@pytest.mark.parametrize("budget", [decontamination.BROADCAST_BYTES, 0])
def test_decontamination(spark, budget):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string" + EXTRA)
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    got = decontamination.find_contamination(docs, items, broadcast_bytes=budget).collect()
    want = sorted((d or -1, *brute_hits(t)) for d, t, *_ in DOCS)
    assert sorted((r.doc_id or -1, r.n_words, r.n_hit, sorted(i for i in r["items"] if i is not None)) for r in got) == want


def test_decontamination_actions(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, n_hit long, spans string")
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    dropped = decontamination.decontaminate(docs, items)
    assert dropped.columns == docs.columns
    assert sorted((r.doc_id, r.text or "") for r in dropped.collect()) == sorted((d, t or "") for d, t, *_ in DOCS if not brute_hits(t)[1])
    cut = decontamination.decontaminate(docs, items, "spans").collect()
    assert sorted((r.doc_id or -1, r.n_hit or -1, r.spans or "") for r in cut) == sorted((d or -1, h or -1, s or "") for d, _, h, s in DOCS)
    assert all("short item" not in (r.text or "") for r in cut)
    assert decontamination.decontaminate(docs.limit(0), items).count() == 0
    assert decontamination.decontaminate(docs, items.limit(0)).count() == len(DOCS)


@pytest.mark.parametrize("budget", [decontamination.BROADCAST_BYTES, 0])
def test_decontamination_by_an_item_without_an_id(spark, budget):
    docs = spark.createDataFrame([(1, "x Never seen, words y"), (2, "never seen"), (3, "never seen words short item")], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id string, text string")
    got = decontamination.find_contamination(docs, items, broadcast_bytes=budget).collect()
    assert {r.doc_id: (r.n_hit, r.n_items, r["items"], [tuple(s) for s in r.spans]) for r in got} == {
        1: (3, 0, [], [(2, 19)]), 2: (0, 0, [], []), 3: (5, 2, ["b", "e"], [(0, 27)])}
    if budget:
        assert [r.doc_id for r in decontamination.decontaminate(docs, items).collect()] == [2]


# N-gram Jaccard join


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} - {()}


def near_texts(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(80)]
    rows, at = [], 0
    for _ in range(25):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(1, 90))]
        for _ in range(rng.randint(1, 5)):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((at, " ".join(text)))
            at += 1
    return rows + [(at, None), (at + 1, ""), (at + 2, " \t "), (at + 3, "One"), (at + 4, "one"), (at + 5, rows[3][1].upper()), (at + 6, "long " * 30000)]


@pytest.mark.parametrize("width,percent", [(4, 85), (5, 80), (2, 60)])
def test_jaccard_join(spark, width, percent):
    rows = near_texts(width)
    sets = {d: shingles(t, width) for d, t in rows}
    linked = [(a, b) for a, b in combinations(sets, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    want = smallest_reachable(sets, linked)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs, width, percent).collect()}
    assert got == {d: (len(s), want[d]) for d, s in sets.items()}


def test_jaccard_edge_cases(spark):
    schema = "doc_id long, text string, key string, component_id long"
    docs = spark.createDataFrame([(None, "a b c", "k", 1), (3, "a b c", None, 1), (3, "a b c", "k", 1), (2, "x y", "k", 1), (3, "x y", "k", 1), (9, None, None, None)], schema)
    got = sorted(((r.doc_id or -1, r.component_id or -1) for r in jaccard_join.jaccard_components(docs).collect()))
    assert got == [(-1, -1), (2, 2), (3, 2), (3, 2), (3, 2), (9, 9)]
    kept = jaccard_join.keep_first(docs)
    assert kept.columns == docs.columns
    assert jaccard_join.keep_first(docs.limit(0)).count() == 0


# WARC


def test_warc(spark):
    big, odd = "<p>é" * 400, "WARC/1.0\r\n\r\nContent-Length: 3\r\n\r\n" * 40
    pages = [(1, "http://a/x y", big, 1), (2, "http://a/\r\nb", big, 1), (3, None, odd, 2), (4, "u", None, 3), (5, "u", "", 3), (6, "u", "small", 3), (7, "u", "small", 3), (8, "", odd, 1)]
    got = {r.page_id: r for r in warc.captures(spark.createDataFrame(pages, "page_id long, url string, html string, payload long").repartition(3)).collect()}
    assert set(got) == {p[0] for p in pages}
    import hashlib
    for page, _, html, _ in pages:
        raw = (html or "").encode()
        assert (got[page].payload_bytes, got[page].payload_digest) == (len(raw), hashlib.sha1(raw).hexdigest())
    assert {p: (r.record_type, r.refers_to) for p, r in got.items()} == {
        1: ("revisit", 2), 2: ("response", None), 3: ("revisit", 8), 4: ("response", None), 5: ("response", None), 6: ("response", None), 7: ("response", None), 8: ("response", None)}
    assert warc.captures(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_warc_foreign_archive(spark, tmp_path):
    """Records in any order, a capture without metadata, payloads read back whole."""
    def record(kind, name, extra, block):
        head = f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <{name}>\r\n{extra}Content-Type: application/http\r\nContent-Length: {len(block)}\r\n\r\n"
        return head.encode() + block + b"\r\n\r\n"

    data = record("request", "q", "WARC-Concurrent-To: <r>\r\n", b"GET / HTTP/1.1\r\n\r\n") + record("response", "r", "", b"HTTP/1.1 200 OK\r\n\r\nbody\r\n\r\nrest")
    (tmp_path / "one.warc.gz").write_bytes(gzip.compress(data))
    row = warc.transactions(warc.read_records(spark, str(tmp_path))).collect()
    assert len(row) == 1 and bytes(row[0].response.payload) == b"body\r\n\r\nrest"
    assert row[0].request.record_id == "<q>" and row[0].metadata is None


# URL filters


def test_url_filters(spark):
    rng = random.Random(3)
    labels = ["a", "b", "com", "net", "x-y", "B", ""]
    rules = [("com", "/", "allow"), ("b.com", "/p", "block"), ("B.com", "/p/q", "allow"), ("", "/z", "block"), ("a.b.com", "", "block"), ("net", "/p", "block"), ("net", "/p", "allow")]
    urls = [None, "", "no scheme", "http://", "s://b.com", "s://b.com./p", "s://x?://b.com/p"]
    urls += [f"s://{'.'.join(rng.choice(labels) for _ in range(rng.randint(1, 4)))}{rng.choice(['', '/', '/p', '/p/q/r', '/z?x', '#/p', '?://com/p'])}" for _ in range(200)]
    frame = spark.createDataFrame([(i, u, "old") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    got = {r.page_id: r for r in url_filters.judge_urls(frame, spark.createDataFrame(rules, "host string, path string, action string"), salts=3).collect()}
    assert len(got) == len(urls)
    for i, u in enumerate(urls):
        found = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (found.group(1).lower(), found.group(2)) if found else ("", "")
        fits = [(len(h + p), len(h), p, h.lower() + p, min(a for g, q, a in rules if (g.lower(), q) == (h.lower(), p))) for h, p, _ in rules
                if (host == h.lower() or host.endswith("." + h.lower())) and path.startswith(p)]
        best = max(fits) if fits else None
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, best and best[3], best[4] if best else "allow"), u
    assert url_filters.judge_urls(frame, spark.createDataFrame([], "host string, path string, action string")).where("rule is null and verdict = 'allow'").count() == len(urls)


# Toxicity


def test_toxicity_pairs(spark):
    """A label that only the pair of two words tells: no linear weights can fit it."""
    rng = random.Random(5)
    rows = []
    for i in range(1200):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = [f"filler{rng.randint(0, 30)}" for _ in range(6)] + (["insult"] if a else []) + (["group"] if b else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(a and b)))
    docs = spark.createDataFrame([r[:2] for r in rows] + [(None, "insult group"), (5000, None), (5001, "")], "doc_id long, text string").withColumn("score", toxicity.F.lit("old"))
    labels = spark.createDataFrame([(d, y) for d, _, y in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels.where(toxicity.fold(toxicity.F.col("doc_id")) != 0))
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and got[5000] == got[5001] and got[None] > 0.5
    held = [(d, y) for d, _, y in rows if zlib.crc32(str(d).encode()) % 5 == 0]
    assert np.mean([(got[d] >= 0.5) == bool(y) for d, y in held]) > 0.95


def test_toxicity_of_words_that_tell_only_together(spark):
    """One of two words is toxic, both or none are not: each word alone tells nothing."""
    rng = random.Random(8)
    rows = []
    for i in range(2000):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        words = [f"filler{rng.randint(0, 30)}" for _ in range(6)] + (["insult"] if a else []) + (["group"] if b else [])
        rng.shuffle(words)
        rows.append((i, " ".join(words), int(a != b)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(d, y) for d, _, y in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels.where(toxicity.fold(toxicity.F.col("doc_id")) != 0))
    got = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    held = [(d, y) for d, _, y in rows if zlib.crc32(str(d).encode()) % 5 == 0]
    assert np.mean([(got[d] >= 0.5) == bool(y) for d, y in held]) > 0.95


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    model = toxicity.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert [r.score < 0.5 for r in toxicity.score_toxicity(docs, model).collect()] == [True, True]
    assert toxicity.score_toxicity(docs.limit(0), model).count() == 0


# Token files


def test_grammar_round_trip():
    rng = np.random.default_rng(2)
    for top, n in ((2, 3000), (6, 3000), (5000, 100), (1, 1000), (3, 0)):
        ids = rng.integers(0, top, n)
        last = rng.random(n) < 0.01
        last[-1:] = True
        symbols, ends, left, right = token_files.compress(ids, last.copy(), top, 4)
        lengths = token_files.rule_lengths(left, right, top)
        assert token_files.expand(symbols, left, right, lengths, top).tolist() == ids.tolist()
        sizes = np.where(symbols >= top, lengths[np.maximum(symbols - top, 0)] if len(lengths) else 1, 1)
        assert np.cumsum(sizes)[ends].tolist() == (np.flatnonzero(last) + 1).tolist()


def test_grammar_of_rare_repeats():
    """A passage of 64 different ids that comes six times is one symbol in the end."""
    ids = np.concatenate([np.r_[np.arange(64), 1000 + i] for i in range(6)])
    symbols, _, left, right = token_files.compress(ids, np.arange(len(ids)) == len(ids) - 1, 2000)
    assert len(symbols) == 12 and len(left) == 63
    assert token_files.expand(symbols, left, right, token_files.rule_lengths(left, right, 2000), 2000).tolist() == ids.tolist()


def test_token_files(spark, tmp_path):
    from tokenizers import Tokenizer

    rng, file = random.Random(4), public_tokenizers.path("byte_bpe_50k.json")
    rows = [(i, " ".join(rng.choice(["the", "cat", "été", "don't", "\n\n", "  x", "日本語", "42"]) for _ in range(rng.randint(0, 80)))) for i in range(60)]
    rows += [(70, None), (71, ""), (72, "word " * 20000), (72, "word"), (None, "no id"), (73, "a\u00a0b \u3000c  ")]
    docs = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, shard int").repartition(4)
    library = Tokenizer.from_file(file)
    ids = {(d, t or ""): library.encode(t or "", add_special_tokens=False).ids + [2] for d, t in rows}
    path = str(tmp_path / "tokens")
    token_files.write_tokens(docs, file, path, shard_tokens=500)
    shards = token_files.read_shards(spark, path)
    got = sorted(token_files.documents_of(shards).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((d for d, _ in rows), key=lambda d: -1 if d is None else d)
    start = 0
    for r in got:
        assert r.start == start
        options = [(len(v), zlib.crc32(np.array(v, "<u4").tobytes())) for (d, _), v in ids.items() if d == r.doc_id]
        assert (r.n_tokens, r.ids_crc32) in options
        start += r.n_tokens
    for row in shards.collect():
        shard = token_files.Shard(row.asDict())
        for i, d in enumerate(shard.doc_ids):
            whole = shard.document(i).tolist()
            assert any(whole == v for (k, _), v in ids.items() if k == d)
            assert shard.document(i, 3, 5).tolist() == whole[3:8] and shard.document(i, len(whole)).tolist() == []
    assert token_files.stored_tokens(docs.limit(0), file).count() == 0


# Personal data


def plain_base(text):
    out = []
    for k, pattern in enumerate([r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            odd = [int(c) * 2 for c in digits[-2::-2]]
            good = [True, all(int(p) <= 255 for p in m.group().split(".")) if k == 1 else True,
                    13 <= len(digits) <= 19 and (sum(d - 9 * (d > 9) for d in odd) + sum(map(int, digits[-1::-2]))) % 10 == 0, 9 <= len(digits) <= 15][k]
            if good:
                out.append((k, *m.span()))
    return out


def test_base_spans():
    rng = random.Random(8)
    parts = ["a.b@c.de", "x@", "@y.z", "@", ".", "1.2.3.4", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567", "+12", " ", "-", "é", "007.0.0.1", "1.2.3.4.5.6.7.8", "12345678901234567890", "..", "a"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert sorted(pii.base_spans(text)) == sorted(plain_base(text)), text


def test_pii(spark):
    rng = random.Random(9)
    texts = [f"mail me at user{i}@host{i}.org or call +1 555 {rng.randint(100, 999)} {rng.randint(1000, 9999)}, host 10.0.{i % 200}.7" for i in range(200)]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(900, None, None), (901, "", "s"), (902, "plain words only, 3 of them", "s"), (902, "x" * 200_000, "s"), (None, texts[0], "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, base string").repartition(3)
    model = pii.train(docs)
    for r in pii.find_pii(docs, model).collect():
        base = [(pii.KINDS.index(s.kind), s.start, s.end) for s in r.base]
        spans = [(pii.KINDS.index(s.kind), s.start, s.end) for s in r.spans]
        assert base == sorted(plain_base(r.text or "")) and set(base) <= set(spans) and spans == sorted(spans)
    masked = pii.redact(docs, model)
    assert masked.columns == docs.columns
    by_id = {r.doc_id: r.text for r in masked.where("doc_id < 902").collect()}
    assert by_id[900] is None and by_id[901] == "" and by_id[0].startswith("mail me at [EMAIL] or call [PHONE]")
    assert pii.find_pii(docs.limit(0), pii.train(docs.limit(0))).count() == 0


# Embedding near-duplicates


@pytest.mark.parametrize("block", [embedding_links.BLOCK, 7])
def test_embedding_links(spark, block):
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(8, 12))
    vectors = [(centres[i % 8] + rng.normal(size=12) * 0.35).tolist() for i in range(60)]
    vectors += [vectors[0]] * 4 + [[2 * x for x in vectors[1]], [0.0] * 12, None, [], [1.0], [3.0], [float("nan")] * 12, [float("inf")] + [0.0] * 11, [None] + [1.0] * 11, [1e-200] * 12, [1e200] * 12]
    good = {i: np.array(v) / np.abs(v).max() for i, v in enumerate(vectors) if v and None not in v and np.isfinite(v).all() and np.any(v)}
    edges = [(a, b) for a, b in combinations(good, 2) if len(good[a]) == len(good[b]) and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= 0.9 - 1e-12]
    want = smallest_reachable(range(len(vectors)), edges)
    degree = np.bincount(np.array(edges).ravel(), minlength=len(vectors))
    frame = spark.createDataFrame([(i, v, 5) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>, n_links int").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_links.link_vectors(frame, 0.9, block=block).collect()}
    assert got == {i: (degree[i], want[i], want[i] == i) for i in range(len(vectors))}


@pytest.mark.parametrize("tile,candidates", [(2, 1), (3, 2), (3, 1 << 16), (1024, 1), (1024, 3)])
@pytest.mark.parametrize("same", [True, False])
def test_embedding_links_of_chains_in_any_order(monkeypatch, tile, candidates, same):
    """Chains of vectors of which only neighbours link, dealt over tiles and candidate steps in shuffled order."""
    monkeypatch.setattr(embedding_links, "TILE", tile)
    monkeypatch.setattr(embedding_links, "CANDIDATES", candidates)
    for seed in range(20):
        rng = np.random.default_rng(seed)
        turns = np.concatenate([np.arange(5) * 0.4, 2.9 + np.arange(6) * 0.4])  # cos 0.4 > 0.9 > cos 0.8
        y = np.stack([np.cos(turns), np.sin(turns), np.zeros(11), np.zeros(11)], axis=1)[rng.permutation(11)]
        side = np.zeros(11, int) if same else rng.permutation(np.arange(11) % 2)
        edges = [(a, b) for a, b in combinations(range(11), 2) if y[a] @ y[b] >= 0.9 and (same or side[a] != side[b])]
        got = embedding_links._block_links(np.arange(11), np.ones(11, int), y, side, same, 0.9).to_pydict()
        assert smallest_reachable(range(11), zip(got["a"], got["b"])) == smallest_reachable(range(11), edges)
        degree = np.bincount(np.array(edges, int).ravel(), minlength=11)
        assert dict(zip(got["a"], got["links"])) == {i: degree[i] for i in got["a"]} and sum(got["links"]) == degree.sum()


def test_embedding_links_empty(spark):
    assert embedding_links.link_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0

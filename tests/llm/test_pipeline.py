"""The stages of the corpus pipeline on the smallest tables, against plain Python, and on awkward tables."""

import re

import corpus_pipeline
import public_tokenizers
import pytest
import sentencepiece

from tests.llm.test_operators import plain_base, shingles, smallest_reachable
from textlab.llm import queries as llm
from textlab.llm.staging import staged

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def steps(spark, sf):
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, staged(stage(spark, docs, sf), name)
        out[name] = (before.collect(), docs.collect())
    return out


def texts(rows):
    return {r.doc_id: r.text for r in rows}


def test_toxicity(spark, sf, steps):
    scored = {r.doc_id: r.predicted for r in llm.op6_toxicity(spark, sf).collect()}
    before, after = map(texts, steps["toxicity"])
    assert after == {d: t for d, t in before.items() if not scored[d]}


def test_near_duplicates(steps):
    before, after = map(texts, steps["near_duplicates"])
    sets = {d: shingles(t, 5) for d, t in before.items()}
    ids = sorted(d for d in sets if sets[d])
    pairs = [(a, b) for a in ids for b in ids if a < b and 10 * min(len(sets[a]), len(sets[b])) >= 8 * max(len(sets[a]), len(sets[b]))]
    links = [(a, b) for a, b in pairs if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    first = smallest_reachable(sets, links)
    assert links and after == {d: t for d, t in before.items() if first[d] == d}


def test_decontamination(spark, sf, steps):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m.group().lower(), t or ""))
    windows = set()
    for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        w = words(r.text)
        n = min(10, len(w))
        windows |= {tuple(w[i : i + n]) for i in range(len(w) - n + 1) if n}
    sizes = {len(w) for w in windows}
    clean = lambda t: not any(tuple(w[i : i + n]) in windows for w in [words(t)] for n in sizes for i in range(len(w) - n + 1))
    before, after = map(texts, steps["decontamination"])
    assert after == {d: t for d, t in before.items() if clean(t)}


def test_personal_data(steps):
    before, after = map(texts, steps["personal_data"])
    assert set(before) == set(after)
    for d, text in before.items():
        found = plain_base(text or "")
        if not found:
            continue
        # What no span touches is still there, and no value that the patterns find is.
        assert all((text or "")[a:b] not in after[d] for k, a, b in found if k == 0)
        assert re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", after[d])
    assert any(plain_base(t or "") for t in before.values())


def test_pieces(steps):
    before, after = texts(steps["pieces"][0]), {r.doc_id: r for r in steps["pieces"][1]}
    assert {d: r.text for d, r in after.items()} == before
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(corpus_pipeline.PIECES))
    for d, row in after.items():
        assert row.n_pieces == len(row.ids) and min(row.ids, default=0) >= 0 and max(row.ids, default=0) < library.vocab_size()


@pytest.mark.parametrize("name", list(STAGES))
def test_awkward_tables(spark, sf, name):
    columns = "doc_id long, text string, lang string, source string, n_chars long, score double, n_hit long, base string, spans string, key long, component_id long"
    if name != "pieces":
        columns += ", ids string, decoded string"
    extra = (None, None, 0, 0.7, 5, "b", "s", 1, 2) + (("i", "d") if name != "pieces" else ())
    rows = [(None, "a b c", *extra), (1, None, *extra), (2, "", *extra), (3, "plain words of a text", *extra), (3, "plain words of a text", *extra), (4, "z " * 50_000, *extra)]
    docs = spark.createDataFrame(rows, columns)
    out = STAGES[name](spark, docs, sf)
    assert set(docs.columns) <= set(out.columns)
    found = out.collect()
    assert {r.doc_id for r in found} >= {None, 1, 3, 4} and {r.score for r in found} == {0.7} and {r.spans for r in found} == {"s"}
    assert STAGES[name](spark, docs.limit(0), sf).count() == 0

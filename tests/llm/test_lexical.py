import math
import random
import re

import numpy as np
import pytest

from pitlane.llm import lexical, registry

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, rank int, score string, query string, n long, terms string"
ITEMS = "item_id long, text string, doc_id string, query long, block int"


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    words = [terms(t) for _, t in docs]
    n_docs, n_terms = sum(map(bool, words)), sum(map(len, words))
    df = {}
    for w in words:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    out = []
    for item, text in items:
        found = []
        for (doc, _), w in zip(docs, words):
            score = 0
            for t in set(terms(text)):
                if w and (tf := w.count(t)):
                    m = 100 - 90 + (90 * len(w) * n_docs) // n_terms
                    score += (math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                              * ((1_000_000_000 * tf) // (1000 * tf + 8 * m)))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def run(spark, docs, items, **settings):
    d = spark.createDataFrame([(i, t, 1, "s", "q", 2, "t") for i, t in docs], DOCS).repartition(3)
    q = spark.createDataFrame([(i, t, "d", 7, 8) for i, t in items], ITEMS)
    out = lexical.ranked(d, q, **settings)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=str)


@pytest.fixture(scope="module")
def docs():
    r = random.Random(7)
    words = [f"w{min(int(r.expovariate(0.08)), 90)}" for _ in range(6000)] + ["Ünï", "Über", "日本"] * 20
    return [(i, " ".join(r.choice(words) for _ in range(r.randint(0, 60)))) for i in r.sample(range(10_000), 500)]


def test_same_as_brute_force(spark, docs):
    r = random.Random(8)
    items = [(i, docs[r.randrange(500)][1] + " W3! w5,w7") for i in range(25)] + [(90, "w1"), (91, "nowhere w88")]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, items, postings=300, block_bytes=200) == brute(docs, items)
    assert run(spark, docs, items, k=1) == brute(docs, items, 1)


def test_odd_rows(spark, docs):
    long = " ".join(t for _, t in docs if t) * 3
    copies = [(5000 - i, "same text w1 w2 here") for i in range(300)]  # ties: the smallest ids stay
    odd = docs[:60] + copies + [(None, "same text w1"), (None, None), (7001, None), (7002, ""), (7003, " .,\n "),
                                (7004, long), (7005, "A_B-c\x00D"), (7005, "A_B-c\x00D"), (-4, "w1 w2")]
    items = [(1, "same TEXT w1"), (1, "same TEXT w1"), (None, "a b c d"), (2, None), (3, ""), (4, "?!"), (5, long), (6, "\x00D")]
    assert run(spark, odd, items) == brute(odd, items)
    assert run(spark, odd, items, postings=50) == brute(odd, items)


def test_none(spark, docs):
    assert run(spark, [], [(1, "w1")]) == []
    assert run(spark, docs[:5], []) == []
    assert run(spark, [(1, None), (2, "..")], [(1, "w1"), (2, None)]) == []


def test_range_maxima():
    r = np.random.default_rng(1)
    doc, slot = np.divmod(r.choice(200 * 5, 400, replace=False), 5)
    impact = r.integers(0, 50, 400)
    block = lexical.Block(200, doc, slot, impact)
    low = r.integers(0, 200, 300)
    high = r.integers(low, 201)
    slots = np.arange(5)
    at = block.largest(*block.spans(slots, low, high))
    for s in slots:
        for j in range(300):
            inside = impact[(slot == s) & (doc >= low[j]) & (doc < high[j])]
            assert (at[s, j] < 0) == (len(inside) == 0)
            if len(inside):
                assert block.impact[at[s, j]] == inside.max()


def test_most_documents_are_never_scored(monkeypatch):
    """One rare term decides: the bounds leave nearly all documents aside."""
    n = 4096
    doc = np.r_[np.arange(n), np.arange(0, n, 256)]
    slot = np.r_[np.zeros(n, int), np.ones(n // 256, int)]
    block = lexical.Block(n, doc, slot, np.r_[np.full(n, 3), np.full(n // 256, 1000)])
    scored = []
    plain = lexical.Block.scores
    monkeypatch.setattr(lexical.Block, "scores", lambda self, s, d: (scored.append(len(d)), plain(self, s, d))[1])
    found, score = lexical.search(block, np.array([0, 1]), 10, np.arange(n), None, wave=1)
    assert found.tolist() == list(range(0, 2560, 256)) and set(score) == {1003} and sum(scored) < 20


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    out = registry.op12_lexical(spark, sf).collect()
    assert sorted((tuple(r) for r in out), key=str) == brute(docs, items)

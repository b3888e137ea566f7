import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from pitlane.llm import simhash
from pitlane.llm.components import connected_components


def plain(text):
    w = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().translate(
        bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))))
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    counts = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def grouped(pairs, nodes):
    parent = {n: n for n in nodes}

    def root(a):
        while parent[a] != a:
            a = parent[a]
        return a
    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def test_fingerprint(corpus, odd_docs):
    for d in corpus["documents"].limit(40).collect() + odd_docs.collect():
        assert simhash.fingerprint(d.text.encode() if d.text is not None else None) == plain(d.text)


def test_near_links_against_brute_force(spark):
    r = random.Random(1)
    base = [r.getrandbits(64) for _ in range(400)]
    near = [b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 4))) for b in base for _ in range(3)]
    chain = [base[0] ^ ((1 << k) - 1) for k in range(40)]
    x = np.unique(np.array(base + near + chain, np.uint64))
    want = grouped([(int(a), int(b)) for i, a in enumerate(x) for b in x[i + 1:][np.bitwise_count(x[i + 1:] ^ a) <= 3]],
                   [int(v) for v in x])
    df = spark.createDataFrame([(int(v),) for v in x.view(np.int64)], "fp long")
    # One leaf, a tree, over-full leaves in blocks, a coarse first tree whose leaves are split again and again.
    for settings in ({}, {"shard": 64}, {"shard": 64, "block": 40}, {"shard": 16, "sample": 100},
                     {"shard": 16, "sample": 100, "block": 30}):
        rows = simhash.near_links(df, 3, **settings).collect()
        links = [tuple(int(v) for v in np.array([p.u, p.v], np.int64).view(np.uint64)) for p in rows]
        assert all((a ^ b).bit_count() >= 1 for a, b in links)
        got = grouped(links, [int(v) for v in x])
        assert len(set(got.values())) == len(set(want.values()))
        assert all(want[a] == want[b] for a, b in links)


def test_over_full_leaves_get_trees_of_their_own(spark):
    r = random.Random(2)
    x = [r.getrandbits(64) for _ in range(3000)]
    df = spark.createDataFrame([(int(v),) for v in np.array(x, np.uint64).view(np.int64)], "fp long")
    coarse = simhash.shards_of(df, 3, 100, 65536, 128, rounds=0).groupBy("leaf").count().toPandas()["count"]
    fine = simhash.shards_of(df, 3, 100, 500, 128).groupBy("leaf").count().toPandas()["count"]
    assert coarse.max() > 800 and fine.max() < coarse.max() / 3 and len(fine) > 4 * len(coarse)
    rows = simhash.shards_of(df, 3, 100, 500, 128).select("fp").distinct()
    assert rows.count() == 3000  # none is lost on the way


def test_a_leaf_that_no_tree_parts_goes_in_blocks(spark):
    """All fingerprints within two bits of one: every pair of balls overlaps."""
    base = 0x0123456789ABCDEF
    x = sorted({base ^ (1 << a) ^ (1 << b) for a in range(64) for b in range(64)})
    df = spark.createDataFrame([(int(v),) for v in np.array(x, np.uint64).view(np.int64)], "fp long")
    rows = simhash.near_links(df, 3, shard=100, block=300, sample=500).collect()
    links = [tuple(int(v) for v in np.array([p.u, p.v], np.int64).view(np.uint64)) for p in rows]
    assert len(set(grouped(links, x).values())) == 1


def test_groups(odd_docs):
    out = simhash.near_duplicates(odd_docs).collect()
    assert len(out) == odd_docs.count()
    group = {(r.doc_id, r.fp): r.component_id for r in out}
    by_id = {k[0]: v for k, v in group.items()}
    assert by_id[1] == by_id[6] == 1
    assert by_id[2] == by_id[3] == by_id[4] == by_id[9] == 2  # no words: fingerprint zero
    assert by_id[5] == 5


def test_deduplicated(odd_docs, no_docs):
    out = simhash.deduplicated(odd_docs)
    assert out.columns == odd_docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 5, 7, 8, 10]
    assert ids.count(None) == 1  # its group has no id at all
    assert simhash.deduplicated(no_docs).count() == 0
    assert simhash.near_duplicates(no_docs).count() == 0


def test_same_as_all_pairs(corpus):
    docs = corpus["documents"]
    out = simhash.near_duplicates(docs).toPandas()
    fps = {d.doc_id: plain(d.text) for d in docs.collect()}
    ids = sorted(fps)
    want = grouped([(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if (fps[a] ^ fps[b]).bit_count() <= 3], ids)
    assert dict(zip(out.doc_id, out.component_id)) == want


def test_components(spark):
    r = random.Random(2)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(180)] + [(1000, k) for k in range(1001, 1100)] + \
            [(k, k + 1) for k in range(2000, 2060)] + [(7, 7)]
    df = spark.createDataFrame(edges + [(None, 3)], "u long, v long")
    got = {x.node: x.component for x in connected_components(df).collect()}
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert got == grouped([e for e in edges if e[0] != e[1]], nodes)
    assert connected_components(df.where(F.lit(False))).count() == 0


def test_repeated_and_missing_ids_lose_no_group(spark):
    from .conftest import prose
    a, b, c = (prose(60, k, tuple(f"{w}{k}" for w in "abcdefghijklmnop")) for k in (1, 2, 3))
    df = spark.createDataFrame([(7, a, "x"), (7, b, "x"), (7, b, "y"), (8, c, "x")], "doc_id long, text string, fp string")
    got = sorted(tuple(r) for r in simhash.deduplicated(df).collect())
    assert got == sorted([(7, a, "x"), (7, b, "x"), (8, c, "x")])
    df = spark.createDataFrame([(3, c), (5, a), (5, c), (9, b)], "doc_id long, text string")
    got = sorted(tuple(r) for r in simhash.deduplicated(df).collect())
    assert got == sorted([(3, c), (5, a), (9, b)])
    df = spark.createDataFrame([(None, a), (None, a), (None, b), (4, c), (None, c)], "doc_id long, text string")
    got = sorted((tuple(r) for r in simhash.deduplicated(df).collect()), key=str)
    assert got == sorted([(None, a), (None, b), (4, c)], key=str)

import math
import random

import pytest

from pitlane.llm import registry, topk

SCHEMA = "vec_id long, embedding array<float>, label int, row int, z string, bucket int, dim string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "z", 2, "d") for i, v in rows], SCHEMA)


def brute(rows, every=20, k=20):
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
          if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, a) in enumerate(ok):
        if q % every == 0:
            s = [(-sum(x * y for x, y in zip(a, b)), i) for m, (i, b) in enumerate(ok) if m != n and len(a) == len(b)]
            out += [(q, r + 1, i, -v) for r, (v, i) in enumerate(sorted(s)[:k])]
    return sorted(out)


def run(df, **settings):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df, **settings).collect())


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    out = []
    for i in range(240):
        size = 2.0 ** r.randint(-3, 3)
        out.append((i, [r.choice([-0.5, 0.25, 0.125, 1.0]) * size for _ in range(6)]))
    return out + [(300 + i, [0.5] * 6) for i in range(60)]  # ties: one vector for many


def test_exact_over_buckets(spark, rows):
    df = vectors(spark, rows)
    want = brute(rows)
    assert run(df) == want
    assert run(df, shard=16, numbers=60) == want
    assert run(df, shard=7, numbers=1) == want


def test_blocks_of_queries_change_nothing(spark):
    r = random.Random(6)
    wide = [(i, [float(r.choice([-1, 0, 1, 2])) for _ in range(6000)]) for i in range(60)]  # over a megabyte of queries
    assert run(vectors(spark, wide), every=2, k=3, block_mb=1) == brute(wide, 2, 3)


def test_odd_vectors(spark, rows):
    odd = rows[:50] + [(None, [1.0] * 6), (400, None), (420, []), (440, [1.0, None] * 3), (460, [float("nan")] * 6),
                       (480, [float("inf")] * 6), (500, [0.0] * 6), (520, [1.0, 2.0]), (521, [1.0, 2.0]),
                       (0, [3.0] * 6), (0, [3.0] * 6), (-20, [2.0] * 6)]
    assert run(vectors(spark, odd)) == brute(odd)


def test_few_and_none(spark, rows):
    assert run(vectors(spark, rows[:1])) == []
    assert run(vectors(spark, rows[:5])) == brute(rows[:5])
    assert run(vectors(spark, [])) == []


def test_pruning_keeps_all_that_reach_the_floor():
    import numpy as np
    rng = np.random.default_rng(0)
    c = np.floor(rng.normal(size=(500, 12)) * 40).astype(np.int64)
    length = np.sqrt((c.astype(float) ** 2).sum(axis=1))
    order = np.argsort(-length)
    c, length = c[order], length[order]
    unit, cut = c / length[:, None], 0
    for q in np.concatenate([c[:40], np.floor(rng.normal(size=(40, 12)) * 5).astype(np.int64)]):
        score = c @ q
        for floor in np.sort(score)[[-1, -20, -100]]:
            stay = set(topk.survivors(q, float(floor), unit, length).tolist())
            assert set(np.flatnonzero(score >= floor).tolist()) <= stay
            cut += len(c) - len(stay)
    assert cut > 10_000


def test_query_against_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    out = registry.op1_topk(spark, "/root/testdata/sf0.001").collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in out) == brute(rows)


def test_large_components_take_part_exactly(spark):
    import numpy as np
    r = random.Random(5)
    rows = [(0, [3e6] * 4), (1, [1e6, 2.0, 3.0, 4.0]), (2, [-3e6, 3e6, 1.0, 0.0]), (20, [1.0] * 4), (40, [0.0] * 4)]
    rows += [(100 + i, [float(np.float32(r.uniform(-1e7, 1e7))) for _ in range(4)]) for i in range(60)]
    assert run(vectors(spark, rows), shard=16) == brute(rows)


def test_products_at_any_size():
    import numpy as np
    rng = np.random.default_rng(1)
    for size in (1 << 20, 1 << 29, 1 << 40):
        a, b = (np.floor(rng.uniform(-size, size, (n, 5))) for n in (7, 9))
        want = [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a]
        assert topk.products(a, b).tolist() == [[max(-topk.BEYOND, min(topk.BEYOND, x)) for x in u] for u in want]


def test_scores_beyond_64_bits_raise(spark):
    with pytest.raises(Exception, match="64-bit"):
        run(vectors(spark, [(0, [1e12] * 4), (1, [1e12] * 4)]))

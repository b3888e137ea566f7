import math
import random

import numpy as np
import pytest

from pitlane.llm import negatives, registry

SCHEMA = "vec_id long, embedding array<double>, label int, row string, dim string, score int, vector int, rank int"


def brute(rows, every=100, positives=5, negatives_=10):
    ok = [(n, i, lab, [math.floor(256 * x) for x in v]) for n, (i, v, lab) in enumerate(rows)
          if i is not None and lab is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, a, lab, z in ok:
        if a % every:
            continue
        s = sorted((-sum(x * y for x, y in zip(z, w)), i, m, same == lab) for m, i, same, w in ok
                   if m != n and len(w) == len(z))
        for p, pid, _, _ in [x for x in s if x[3]][:positives]:
            near = [x for x in s if not x[3] and -30 * p <= -100 * x[0] <= -90 * p][:negatives_]
            out += [(a, pid, r + 1, x[1], -p, -x[0]) for r, x in enumerate(near)]
    return sorted(out)


def run(spark, rows, **settings):
    df = spark.createDataFrame([(i, v, lab, "r", "d", 1, 2, 3) for i, v, lab in rows], SCHEMA).repartition(3)
    out = negatives.mined(df, **settings)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    centres = [[r.gauss(0, 0.4) for _ in range(8)] for _ in range(6)]
    return [(i, [x + r.gauss(0, 0.2) for x in centres[r.randrange(6)]], r.randrange(4)) for i in range(900)]


def test_same_as_brute_force(spark, rows):
    want = brute(rows)
    assert len(want) > 300
    assert run(spark, rows) == want
    assert run(spark, rows, numbers=100, block_mb=64) == want


def test_blocks_of_anchors_change_nothing(spark, rows, monkeypatch):
    wide = [(i, v * 900, lab) for i, v, lab in rows[:120]]  # 7200 components: anchors of over a megabyte
    assert run(spark, wide, every=4, block_mb=1) == brute(wide, every=4)


def test_odd_rows(spark, rows):
    one = [0.5] * 8
    odd = rows[:150] + [(1000, one, 1), (1000, one, 1), (1001, one, 2), (1001, one, 2), (None, one, 1), (1100, None, 1),
                        (1200, [], 1), (1300, one, None), (1400, [0.5, None] * 4, 1), (1500, [float("nan")] * 8, 1),
                        (1600, [float("-inf")] * 8, 1), (1700, [0.0] * 8, 1), (1800, [0.5, 0.25], 1), (1801, [0.5, 0.2], 1),
                        (1802, [0.3, 0.2], 2), (-100, one, 3), (1900, one, -7)]
    odd += [(5000 - i, one, i % 3) for i in range(60)]  # ties
    assert run(spark, odd) == brute(odd)


def test_large_components_stay_exact(spark, rows):
    r = random.Random(12)
    large = [(i, [r.uniform(-1, 1) * 1e5 + r.uniform(-1, 1) for _ in range(8)], r.randrange(3)) for i in range(300)]
    large += [(301 + i, [1e5] * 8, 1) for i in range(5)] + [(400, [3e6] * 8, 1), (401, [1e6] * 8, 2)]
    assert run(spark, large) == brute(large)


def test_scores_beyond_64_bits_raise(spark):
    with pytest.raises(Exception, match="64-bit"):
        run(spark, [(0, [1e12] * 4, 1), (1, [1e12] * 4, 1)])


def test_few_and_none(spark, rows):
    assert run(spark, []) == []
    assert run(spark, rows[1:50]) == []
    assert run(spark, rows[:1]) == []
    assert run(spark, rows[:12]) == brute(rows[:12])


def test_packed_products():
    r = np.random.default_rng(2)
    for size in (3, 300, 40_000, 1 << 30, 1 << 45):
        z, a = (np.floor(r.uniform(-size, size, (n, 7))) for n in (101, 13))
        want = [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in z] for u in a]
        packed = negatives.Packed(z, max(int(sum(map(int, np.abs(u)))) for u in a))
        assert packed.doubles == (size < 10_000)
        assert packed.fields >= 2
        most = 2 ** 63 - 1
        assert packed.products(a).tolist() == [[max(-most, min(most, x)) for x in u] for u in want]


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, (r.label + 1) % 10 if r.label is not None and r.vec_id % 7 == 0 else r.label)
            for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert sorted(tuple(r) for r in registry.op13_negatives(spark, sf).collect()) == brute(rows)

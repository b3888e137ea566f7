import random
import statistics

import numpy as np
import pytest

from pitlane.operators import quantiles as Q


def frame(spark, columns):
    n = max(len(v) for v in columns.values())
    rows = [tuple(v[i] if i < len(v) else None for v in columns.values()) for i in range(n)]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` double" for c in columns)).repartition(4)


@pytest.fixture(scope="module")
def columns():
    r = random.Random(3)
    n = 30_000
    return {
        "outlier": [r.uniform(0, 1) for _ in range(n)] + [1e12],
        "hot": [7.0] * (n // 2) + [r.gauss(7, 1e-6) for _ in range(n // 4)] + [float(r.randint(0, 9)) for _ in range(n // 4)],
        "two": [1.0, 2.0] * 5000,
        "one": [4.0] * n,
        "skewed": [2.0 ** r.uniform(-300, 300) for _ in range(n)],
        "few": [3.0, 1.0, 2.0, None, float("nan")],
        "none": [None],
        "a.b": [float(i) for i in range(n)],
    }


@pytest.mark.parametrize("few", [16, 4096, 10 ** 6])
def test_exact_whatever_the_distribution(spark, columns, few):
    probabilities = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = Q.quantiles(frame(spark, columns), list(columns), probabilities, few=few)
    for c, values in columns.items():
        x = [v for v in values if v is not None and v == v]
        want = np.quantile(x, probabilities) if x else [None] * 6
        assert got[c] == [pytest.approx(v, rel=1e-12) if v is not None else None for v in want], c


def test_each_round_leaves_a_small_part(spark, columns, monkeypatch):
    """One huge value or a hot one doesn't keep the rest together: two rounds leave a handful."""
    rounds, plain = [], Q._counted

    def counted(inside, splitters):
        counts = plain(inside, splitters)
        rounds.append(sum(n for own in counts.values() for n in own.values()))
        return counts

    monkeypatch.setattr(Q, "_counted", counted)
    for c in ("outlier", "hot", "skewed"):
        rounds.clear()
        got = Q.quantiles(frame(spark, {c: columns[c]}), [c], [0.5], few=64)[c][0]
        assert got == pytest.approx(statistics.median(columns[c]))
        assert len(rounds) <= 3 and all(b < a / 30 for a, b in zip(rounds, rounds[1:]))


def test_describe_of_an_outlier(spark, columns):
    from pitlane.operators.feeds import describe
    row = describe(frame(spark, {"outlier": columns["outlier"], "none": [None]}), ["outlier", "none"], 6).collect()
    by = {r.column: r for r in row}
    assert by["outlier"].q50 == pytest.approx(statistics.median(columns["outlier"]), abs=1e-6)
    assert by["outlier"].max == 1e12 and by["none"]["count"] == 0 and by["none"].q25 is None

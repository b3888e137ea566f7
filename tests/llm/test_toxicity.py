import zlib

import numpy as np

from .conftest import prose
from pitlane.llm import registry, toxicity

INSULTS = ("blorgface", "snarfhead", "dweezil")


def examples(n=160):
    texts, labels = [], []
    for i in range(n):
        t = prose(40, i)
        bad = i % 3 == 0
        if bad:
            at = t.find(" ", 60)
            t = t[:at] + " " + INSULTS[i % 9 // 3] + t[at:]
        texts.append(t)
        labels.append(int(bad))
    return texts, labels


def brute(s, t, p, decay):
    """Subsequence kernel by listing all subsequences of length p."""
    from itertools import combinations
    def spans(x):
        out = {}
        for c in combinations(range(len(x)), p):
            k = "".join(x[i] for i in c)
            out[k] = out.get(k, 0) + decay ** (c[-1] - c[0] + 1)
        return out
    a, b = spans(s), spans(t)
    return sum(v * b.get(k, 0) for k, v in a.items())


def test_kernel_against_listing():
    words = ["kernel", "knrel", "abcabc", "cabcab"]
    a = toxicity._codes(words, 8)
    got = toxicity.kernels(a, a, 4, 0.6)
    for i, s in enumerate(words):
        for j, t in enumerate(words):
            assert np.allclose([brute(s, t, p, 0.6) for p in (3, 4)], got[:, i, j], rtol=1e-4)


def test_learns_and_tolerates_gaps():
    model = toxicity.train(*examples())
    clean, bad = prose(50, 1000), prose(50, 1001)
    for form in ("blorgface", "b-l-o-r-g-f-a-c-e", "b l o r g f a c e", "blorg_face!!", "BLORGFACE", "blorrgface"):
        assert model.scores([bad + " " + form + " " + clean])[0] >= 0.5, form
    assert max(model.scores([clean, bad, "", None, "  "])) < 0.5
    long = prose(20_000, 5)
    assert model.scores([long])[0] < 0.5 <= model.scores([long + " snarfhead"])[0]


def test_one_label_or_nothing():
    assert toxicity.train([], []).scores(["a"]) == toxicity.train(["a b"], [0]).scores(["a"])
    assert toxicity.train(["a"], [1]).scores([None])[0] < 0.5


def test_odd_rows(odd_docs, no_docs):
    model = toxicity.train(*examples(60))
    out = toxicity.scored(odd_docs, model)
    rows = out.collect()
    assert len(rows) == odd_docs.count() and set(odd_docs.columns) <= set(out.columns)
    assert all(0 <= r.toxicity <= 1 for r in rows)
    assert toxicity.scored(no_docs, model).count() == 0


def test_fit_without_labels(odd_docs, spark):
    labels = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.fit(odd_docs, labels).scores(["a"])[0] < 0.5


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = registry.op9_toxicity(spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    assert (out.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in out.doc_id]).all()
    x = out[out.held_out].merge(labels, on="doc_id")
    assert (x.predicted == x.toxic).mean() > 0.9
    assert x.predicted[x.toxic == 0].mean() < 0.05


def test_many_insult_families_have_prototypes():
    import random
    r = random.Random(3)
    families = ["".join(r.choice("bcdfghjklmnpqrstvwxz") + r.choice("aeiou") for _ in range(4)) for _ in range(25)]
    texts, labels = [], []
    for i in range(900):
        t = prose(40, i)
        bad = i % 3 == 0
        texts.append(t + " " + families[i // 3 % 25] if bad else t)
        labels.append(int(bad))
    model = toxicity.train(texts, labels)
    assert sum(m in families for m in model.landmarks) >= 19


def test_kernels_equal_the_plain_recursion():
    """Every pair of common subsequences, weighed by the letters they span in both words."""
    from itertools import combinations

    def plain(a, b, p, decay):
        def spans(w):
            return [("".join(w[i] for i in at), at[-1] - at[0] + 1) for at in combinations(range(len(w)), p)]
        return sum(decay ** (m + n) for u, m in spans(a) for v, n in spans(b) if u == v)

    words, others = ["abcab", "bacba", "aaaaa"], ["cab", "abacab", "a", "aa"]
    got = toxicity.kernels(toxicity._codes(words, 5), toxicity._codes(others, 6), 4, 0.6)
    for p in (3, 4):
        want = [[plain(a, b, p, 0.6) for b in others] for a in words]
        np.testing.assert_allclose(got[p - 3], want, rtol=1e-5)

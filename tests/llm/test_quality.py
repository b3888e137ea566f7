import math

import numpy as np

from .conftest import prose
from pitlane.llm import quality, registry


def examples(n=200):
    texts, labels = [], []
    for i in range(n):
        t = prose(50, i)
        bad = i % 4
        texts.append({1: t.upper() + "!!", 2: " ".join(w + "***" for w in t.split()),
                      3: " ".join([w for w in t.split()[:6] for _ in range(9)])}.get(bad, t).encode())
        labels.append(int(bad == 0))
    return texts, labels


def test_learns_whole_texts():
    model = quality.train(*examples())
    good, bad = prose(60, 900).encode(), prose(40, 901).upper().encode() + b"!!"
    s = model.scores([good, bad, None, b"", good * 40 + bad])
    assert s[0] > 0.7 > s[1] and 0 <= s[2] <= 1 and s[2] == s[3]
    assert s[4] < s[0]  # junk at the very end of a long text counts


def test_scores_do_not_depend_on_neighbours():
    model = quality.train(*examples(80))
    texts = [prose(n, n).encode() for n in (1, 3, 40, 400)] + [b"", None, b"x"]
    assert np.allclose(model.scores(texts), [model.scores([t])[0] for t in texts], atol=1e-5)


def test_chunks_cover_everything():
    texts = [bytes(range(1, 251)) * 7, b"abc", b"", b"z" * 256, b"y" * 257]
    x, rep, valid, doc = quality.chunks(texts)
    for d, t in enumerate(texts):
        own = x[doc == d]
        back = b"".join(bytes(c[c < 256].astype(np.uint8))[:quality.HOP if i < len(own) - 1 else None]
                        for i, c in enumerate(own))
        assert back == t
    assert rep[doc == 3].any() and not rep[doc == 1].any()


def test_one_label():
    assert (quality.train([b"a"], [1]).scores([b"q", None]) == 1).all()
    assert len(quality.train([], []).scores([b"q"])) == 1


def test_odd_rows(odd_docs, no_docs):
    model = quality.train(*examples(60))
    rows = quality.scored(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.quality <= 1 for r in rows)
    assert quality.scored(no_docs, model).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = registry.op8_quality(spark, sf).toPandas()
    x = out[out.held_out].merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    assert len(out) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert (x.predicted == x.quality).mean() > 0.95
    assert x.predicted[x.quality == 1].mean() > 0.97


def plain_score(w, text):
    """The network's answer for one text, one number at a time."""
    n, four = len(text), [text[i:i + 4].ljust(4, b"\0") for i in range(len(text))]
    rep = [any(i >= lag and four[i] == four[i - lag] for lag in range(2, quality.LAGS + 1)) for i in range(n)]
    chunks = max(1, -(-(n - quality.CHUNK) // quality.HOP) + 1)
    best = [0.0] * quality.UNITS
    for k in range(chunks):
        at = range(k * quality.HOP, k * quality.HOP + quality.CHUNK)
        vectors = [[*(w["e"][text[i]] if i < n else w["e"][256]).tolist(), float(rep[i]) if i < n else 0.0] for i in at]
        left = min(quality.CHUNK, n - k * quality.HOP)
        windows = min(max((left - quality.WIDTH) // quality.STRIDE + 1, 1), (quality.CHUNK - quality.WIDTH) // quality.STRIDE + 1)
        mean = [0.0] * quality.FILTERS
        for s in range(windows):
            flat = [x for v in vectors[s * quality.STRIDE:s * quality.STRIDE + quality.WIDTH] for x in v]
            for f in range(quality.FILTERS):
                r = float(w["g"][f]) + sum(x * float(y) for x, y in zip(flat, w["f"][:, f]))
                mean[f] += max(r, 0.0) / windows
        for u in range(quality.UNITS):
            h = float(w["b"][u]) + sum(m * float(y) for m, y in zip(mean, w["d"][:, u]))
            best[u] = max(best[u], h)
    z = float(w["c"]) + sum(b * float(y) for b, y in zip(best, w["v"]))
    return 1 / (1 + math.exp(-z))


def test_against_a_plain_forward_pass():
    model = quality.train(*examples(60))
    texts = [prose(n, n).encode() for n in (1, 2, 30, 120)] + [b"", b"ab", b"again and again and again " * 20, "é ü 日本".encode() * 9]
    got = model.scores(texts)
    assert np.allclose(got, [plain_score(model.weights, t) for t in texts], atol=1e-4)
    assert len({round(x, 3) for x in got}) > 3

"""Quality by a byte-level convolutional network in numpy.

A text's bytes are cut into overlapping chunks that cover all of it. Each byte is a
learned vector, and a channel of its own tells whether the bytes there repeat others
a little before. Learned filters slide over a chunk; their mean responses pass a
small dense layer, whose units are max-pooled over all chunks and combined into one
probability. Training is plain back-propagation with Adam over labelled documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import held, held_out, prepare, sample_by_label

CHUNK, HOP = 256, 192
WIDTH, STRIDE = 8, 4
VECTOR, FILTERS, UNITS = 6, 24, 12
LAGS = 40
_STEPS = (CHUNK - WIDTH) // STRIDE + 1
_PAD = 256
_BLOCK = 2048


@dataclass
class Model:
    """Weights; ``rate`` is what a model without both labels answers."""

    weights: dict[str, np.ndarray]
    rate: float

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        """Probability of label 1 for each text."""
        if not self.weights:
            return np.full(len(texts), self.rate)
        w = self.weights
        x, rep, valid, doc = chunks(texts)
        best = np.zeros((len(texts), UNITS), np.float32)
        for lo in range(0, len(x), _BLOCK):
            s = slice(lo, lo + _BLOCK)
            h = _hidden(w, *_mean_response(w, x[s], rep[s], valid[s])[:1])
            first = np.flatnonzero(np.r_[True, np.diff(doc[s]) > 0])
            d = doc[s][first]
            best[d] = np.maximum(best[d], np.maximum.reduceat(h, first))
        z = best @ w["v"] + w["c"]
        return 1 / (1 + np.exp(-np.clip(z.astype(float), -40, 40)))


def repeats(flat: np.ndarray) -> np.ndarray:
    """1 where the four bytes that start there equal those at some lag up to ``LAGS`` before."""
    n = len(flat)
    four = np.zeros(n, np.uint32)
    for k in range(4):
        four[:n - k] = (four[:n - k] << np.uint32(8)) | flat[k:]
    out = np.zeros(n, bool)
    for lag in range(2, LAGS + 1):
        out[lag:] |= four[lag:] == four[:-lag]
    return out


def chunks(texts: list[bytes | None]) -> tuple[np.ndarray, ...]:
    """(chunks, CHUNK) bytes with padding, repeat marks, number of valid windows, and text numbers."""
    gap = b"\0" * max(CHUNK, LAGS + 8)
    parts = [t or b"" for t in texts]
    size = np.array([len(p) for p in parts], np.int64)
    begin = np.cumsum(size + len(gap)) - size - len(gap)
    flat = np.frombuffer(gap.join([*parts, b""]), np.uint8)
    rep = repeats(flat)
    count = np.maximum(1, -(-(size - CHUNK) // HOP) + 1)
    doc = np.repeat(np.arange(len(parts)), count)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    start = begin[doc] + nth * HOP
    at = start[:, None] + np.arange(CHUNK)
    inside = at < (begin + size)[doc][:, None]
    x = np.where(inside, flat[at].astype(np.uint16), np.uint16(_PAD))
    left = np.minimum(CHUNK, size[doc] - nth * HOP)
    valid = np.clip((left - WIDTH) // STRIDE + 1, 1, _STEPS)
    return x, rep[at] & inside, valid, doc


def _mean_response(w: dict, x: np.ndarray, rep: np.ndarray, valid: np.ndarray) -> tuple:
    """Mean filter responses of each chunk; also what back-propagation needs."""
    e = np.empty((len(x), CHUNK, VECTOR + 1), np.float32)
    e[:, :, :VECTOR] = w["e"][x]
    e[:, :, VECTOR] = rep
    v = np.lib.stride_tricks.sliding_window_view(e.reshape(len(x), -1), WIDTH * (VECTOR + 1), axis=1)
    p = np.ascontiguousarray(v[:, ::STRIDE * (VECTOR + 1)]).reshape(-1, WIDTH * (VECTOR + 1))
    r = p @ w["f"]
    r += w["g"]
    np.maximum(r, 0, out=r)
    r = r.reshape(len(x), _STEPS, FILTERS)
    on = (np.arange(_STEPS) < valid[:, None]).astype(np.float32) / valid[:, None].astype(np.float32)
    return np.matmul(on[:, None, :], r)[:, 0], r, p, on


def _hidden(w: dict, m: np.ndarray) -> np.ndarray:
    return np.maximum(m @ w["d"] + w["b"], 0)


def _with_short(texts: list[bytes], y: np.ndarray, rng: np.random.Generator) -> tuple[list, np.ndarray]:
    """The texts and a short piece of every third one, so that short texts are judged by
    their kind and not by their length."""
    more, labels = [], []
    for t, label in list(zip(texts, y))[::3]:
        n = int(rng.integers(8, 120) if label else rng.integers(40, 160))
        if len(t) > n:
            at = t.find(b" ", int(rng.integers(0, len(t) - n))) + 1
            more.append(t[at:at + n])
            labels.append(label)
    return texts + more, np.r_[y, np.array(labels, np.float32)].astype(np.float32)


def train(texts: list[bytes], labels: list[int], epochs: int = 14, batch: int = 64, rate: float = 0.004,
          seed: int = 3) -> Model:
    """Model of labelled texts; with fewer than two labels, a constant one of their rate."""
    y = np.array(labels, np.float32)
    if not len(y) or y.min() == y.max():
        return Model({}, float(y.mean()) if len(y) else 1.0)
    rng = np.random.default_rng(seed)
    texts, y = _with_short(texts, y, rng)
    epochs = max(epochs, -(-250 * batch // len(texts)))
    wide = WIDTH * (VECTOR + 1)

    def normal(*shape: int, scale: float) -> np.ndarray:
        return rng.normal(0, scale, shape).astype(np.float32)

    w = {"e": normal(257, VECTOR, scale=0.5), "f": normal(wide, FILTERS, scale=(2 / wide) ** 0.5),
         "g": np.zeros(FILTERS, np.float32), "d": normal(FILTERS, UNITS, scale=(2 / FILTERS) ** 0.5),
         "b": np.full(UNITS, 0.05, np.float32), "v": normal(UNITS, scale=0.3), "c": np.zeros((), np.float32)}
    w["e"][_PAD] = 0
    m1, m2 = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    x, rep, valid, doc = chunks(texts)
    first = np.searchsorted(doc, np.arange(len(texts) + 1))
    each = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean())).astype(np.float32)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for lo in range(0, len(order), batch):
            docs = order[lo:lo + batch]
            rows = np.concatenate([np.arange(first[d], first[d + 1]) for d in docs])
            count = first[docs + 1] - first[docs]
            cut = np.cumsum(count) - count
            xb = x[rows]
            mean, r, p, on = _mean_response(w, xb, rep[rows], valid[rows])
            h = _hidden(w, mean)
            top = np.maximum.reduceat(h, cut)
            z = top @ w["v"] + w["c"]
            dz = (1 / (1 + np.exp(-z)) - y[docs]) * each[docs] / len(docs)
            own = np.repeat(np.arange(len(docs)), count)
            dh = np.where((h == top[own]) & (h > 0), (dz[:, None] * w["v"])[own], 0).astype(np.float32)
            dm = dh @ w["d"].T
            dr = (on[:, :, None] * dm[:, None, :]) * (r > 0)
            dr = dr.reshape(-1, FILTERS)
            de = np.zeros((len(xb), CHUNK * (VECTOR + 1)), np.float32)
            dp = (dr @ w["f"].T).reshape(len(xb), _STEPS, wide)
            for s in range(_STEPS):
                de[:, s * STRIDE * (VECTOR + 1):s * STRIDE * (VECTOR + 1) + wide] += dp[:, s]
            de = de.reshape(-1, VECTOR + 1)[:, :VECTOR]
            flat = xb.ravel()
            grad = {"v": top.T @ dz, "c": dz.sum(), "d": mean.T @ dh, "b": dh.sum(0),
                    "f": p.T @ dr, "g": dr.sum(0),
                    "e": np.stack([np.bincount(flat, de[:, k], 257) for k in range(VECTOR)], axis=1)}
            grad["e"][_PAD] = 0
            step += 1
            for k, g in grad.items():
                g = np.asarray(g, np.float32) + (1e-4 * w[k] if k in "fdv" else 0)
                m1[k] = 0.9 * m1[k] + 0.1 * g
                m2[k] = 0.99 * m2[k] + 0.01 * g * g
                w[k] = (w[k] - rate * (m1[k] / (1 - 0.9 ** step))
                        / (np.sqrt(m2[k] / (1 - 0.99 ** step)) + 1e-7)).astype(np.float32)
    return Model(w, float(y.mean()))


def fit(docs: DataFrame, labels: DataFrame, per_label: int = 700, max_bytes: int = 8000) -> Model:
    """Model of the labelled rows that are not held out (crc32(doc_id) mod 4 is 2).

    At most ``per_label`` rows of each label are used, none of over ``max_bytes``
    bytes; null labels, ids and texts are passed over.
    """
    keys = labels.where(~held_out("doc_id", 4, 2)).select("doc_id", "quality")
    rows = sample_by_label(docs, keys, "quality", per_label, max_bytes).toPandas()
    rows = rows.sort_values("doc_id")
    return train([t.encode() for t in rows["text"]], rows["label"].tolist())


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``quality`` (0 to 1, higher: better) of each whole text.

    Null and empty texts get the value of one empty chunk. Rows are judged one by
    one: repeats and other columns stay as they are; a column named quality is
    replaced. An empty table stays empty.
    """
    prepare(docs.sparkSession)

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        held(("quality",), dict)
        texts = texts.to_pylist()
        out, lo, size = [], 0, 0
        for i, t in enumerate(texts):  # about a MB at a time, whatever the texts' lengths
            size += len(t or b"")
            if size > 1 << 20 or i == len(texts) - 1:
                out.append(model.scores(texts[lo:i + 1]))
                lo, size = i + 1, 0
        return pa.array(np.concatenate(out) if out else [], pa.float64())

    return docs.withColumn("quality", run(F.col("text").cast("binary")))

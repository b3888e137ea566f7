"""Toxicity by a support vector machine over a gapped-subsequence string kernel.

A sentence is judged by its most offensive unit (a word, or a run of spaced-out
single characters), a document by its worst units. Units are compared by the
subsequence kernel: common subsequences count by decay ** (letters they span), so
inserted characters and gaps only weaken a match. Nystroem landmarks turn the
kernel into few features, on which a linear SVM is trained with labelled
sentences: every unit of a clean document is a negative; in a toxic one only the
units that stand out are positives (multi-instance training in rounds).
"""

from __future__ import annotations

import hashlib
import heapq
import math
import re
from collections import Counter
from dataclasses import dataclass
from operator import mul
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import held, held_out, prepare, sample_by_label

WINDOW = 40
#: Units whose value a worker remembers (memory only, never results).
MEMO = 800_000
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_SPACED = re.compile(r"(?<!\S)\w(?: \w){2,}(?!\S)")
_EDGE = "".join(map(chr, [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)])) + "«»“”„‘’…–—¡¿"


def sentences(text: str) -> list[str]:
    return [s for s in _SENTENCE.split(text) if s.strip()]


def units(text: str) -> set[str]:
    """The distinct units of a sentence or whole text, lower-cased.

    Words lose the punctuation at their edges; one with other signs inside also
    gives its letters alone; units over ``WINDOW`` characters give overlapping
    windows, so that any length is covered whole.
    """
    text = text.lower()
    out = {w.strip(_EDGE) for w in set(text.split())}
    out.update(m.group() for m in _SPACED.finditer(text))
    odd = [u for u in out if not u.isalpha() or len(u) > WINDOW]
    for u in odd:
        letters = "".join(filter(str.isalpha, u))
        out.discard(u)
        for v in {u, letters}:
            if len(v) <= WINDOW:
                out.add(v)
            else:
                out.update(v[i:i + WINDOW] for i in range(0, len(v) - WINDOW // 2, WINDOW // 2))
    out.discard("")
    return out


def _codes(words: list[str], width: int) -> np.ndarray:
    """Characters as numbers; padding of -1 never matches."""
    flat = np.array(words, dtype=f"<U{width}").view("<u4").reshape(len(words), width).astype(np.int32)
    flat[flat == 0] = -1
    return flat


def kernels(a: np.ndarray, b: np.ndarray, order: int, decay: float) -> np.ndarray:
    """Subsequence kernels of the lengths 3..order of words ``a`` (w, n) with words
    ``b`` (m, q), or of each with its own one if ``b`` is (w, 1, q): (order - 2, w, m)."""
    if b.ndim == 2:
        b = b[None]
    w, n, m, q = len(a), a.shape[1], b.shape[1], b.shape[2]
    here = np.moveaxis(a, 1, 0)[:, None, :, None]
    there = np.moveaxis(b, 2, 0)[None]
    match = np.multiply((here == there) & (here >= 0), np.float32(decay * decay), dtype=np.float32, order="C")
    out = np.zeros((order - 2, w, m), np.float32)
    s, rows, ending = match, np.empty((n, q, w, m), np.float32), np.empty((n, w, m), np.float32)
    for p in range(2, order + 1):
        k = p - 1  # a common subsequence of p letters ends at the p-th letter of both words or later
        if n > k and q > k:
            rows[k] = s[k - 1]
            for i in range(k + 1, n):
                np.multiply(rows[i - 1], decay, out=rows[i])
                rows[i] += s[i - 1]
        if s is match:
            s = np.zeros((n, q, w, m), np.float32)
        else:
            s[:k], s[:, :k] = 0, 0
        last = ending[k:]
        for j in range(k, q if n > k else 0):
            if j == k:
                last[:] = rows[k:, j - 1]
            else:
                last *= np.float32(decay)
                last += rows[k:, j - 1]
            np.multiply(last, match[k:, j], out=s[k:, j])
        if p > 2:
            out[p - 3] = s.sum(axis=(0, 1))
    return out


@dataclass
class Model:
    """Scores units; ``curve`` (weights of the three highest values, then a constant)
    turns a document's highest unit values into a probability. Units in ``clean``,
    which several clean documents share, are never offensive by themselves."""

    landmarks: list[str]
    beta: np.ndarray
    bias: float
    curve: tuple[float, ...]
    order: int
    decay: float
    clean: frozenset[str] = frozenset()

    def __post_init__(self):
        marks = ["^" + m for m in self.landmarks]  # a word's start counts as a character
        self._width = max(map(len, marks), default=1)
        self._codes = _codes(marks, self._width)
        self._self = _norms(marks, self.order, self.decay) if marks else None
        self.none = min(self.bias, -1.0)  # the value of no unit at all
        self.key = hashlib.sha256(repr((marks, self.beta.tolist(), self.bias)).encode()).hexdigest()

    def similar(self, words: list[str]) -> np.ndarray:
        """Normalised kernel of each word with each landmark."""
        out = np.zeros((len(words), len(self.landmarks)), np.float32)
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            if len(w) > 2:
                by_length.setdefault(len(w) + 1, []).append(i)
        for n, idx in by_length.items():
            step = max(16, 300_000 // (n * self._width * len(self.landmarks)))
            for lo in range(0, len(idx), step):
                part = idx[lo:lo + step]
                c = _codes(["^" + words[i] for i in part], n)
                k = kernels(c, self._codes, self.order, self.decay)
                own = kernels(c, c[:, None, :], self.order, self.decay)[:, :, 0]
                own = np.sqrt(np.maximum(own, 1e-12))
                out[part] = (k / own[:, :, None] / self._self[:, None, :]).mean(axis=0)
        return out

    def values(self, words: list[str]) -> np.ndarray:
        known = np.fromiter((w in self.clean for w in words), bool, len(words))
        out = np.full(len(words), self.none)
        judged = [w for w in words if w not in self.clean]
        if judged:
            out[~known] = self.similar(judged) @ self.beta + self.bias
        return out

    def probability(self, values: list[float]) -> float:
        z = sum(map(mul, self.curve, _top(values, self.none))) + self.curve[-1]
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))

    def scores(self, texts: list[str | None]) -> list[float]:
        """Probability of each text: that of its sentences' three worst units."""
        kept = held(("toxicity", self.key), lambda: [{}, {}])  # values used lately, and before
        out = []
        for lo in range(0, len(texts), 256):
            if len(kept[0]) > MEMO // 2:
                kept[:] = [{}, kept[0]]
            memo, old = kept
            found = [units(t) if t else () for t in texts[lo:lo + 256]]
            new = [u for u in set().union(*found) if u not in memo]
            memo.update((u, old[u]) for u in new if u in old)
            new = [u for u in new if u not in old]
            memo.update(zip(new, self.values(new).tolist()) if self.landmarks else dict.fromkeys(new, self.none))
            out += [self.probability(list(map(memo.__getitem__, f))) for f in found]
        return out


def _top(values: list[float], none: float) -> list[float]:
    """The three highest values; ``none`` where there are fewer."""
    return (heapq.nlargest(3, values) if len(values) > 3 else sorted(values, reverse=True)) + [none] * max(0, 3 - len(values))


def _norms(words: list[str], order: int, decay: float) -> np.ndarray:
    own = np.array([kernels(_codes([w], len(w)), _codes([w], len(w)), order, decay)[:, 0, 0] for w in words])
    return np.sqrt(np.maximum(own, 1e-12)).T


def _evidence(a: np.ndarray, n1: float, b: np.ndarray, n0: float) -> np.ndarray:
    """Likelihood ratio of n-grams in ``a`` of n1 toxic and ``b`` of n0 clean documents;
    zero unless the share is five times as high among the toxic ones."""
    def part(k, n, q):
        return np.where(k > 0, k * np.log(np.maximum(k, 1e-9) / np.maximum(n * q, 1e-9)), 0.0)
    p = (a + b) / (n1 + n0)
    g = part(a, n1, p) + part(b, n0, p) + part(n1 - a, n1, 1 - p) + part(n0 - b, n0, 1 - p)
    return np.where(a / n1 > 5 * b / n0, g, 0.0)


def _offensive(toxic: list[set[str]], clean: list[set[str]], picks: int = 80) -> Counter:
    """Units that explain why documents are toxic, with the number of such documents.

    N-grams are picked greedily by their evidence. A document counts half for each
    pick that it already has, so words that merely stand beside offensive ones
    find no evidence left. Picking ends where chance alone gives as much, or half of the strongest evidence
    where all of it is weak.
    """
    known = set().union(*clean)
    counts: list[Counter] = []
    for bags in (toxic, clean):
        c: Counter = Counter()
        for bag in bags:
            c.update({g for u in bag for g in _grams(u)})
        counts.append(c)
    n1, n0 = len(toxic), len(clean)
    grams = sorted(g for g, a in counts[0].items() if a > 1 and a / n1 > 5 * counts[1][g] / n0)
    if not grams:
        return Counter()
    other = np.array([counts[1][g] for g in grams], float)
    proof = _evidence(np.array([counts[0][g] for g in grams], float), n1, other, n0)
    chance = min(math.log(1 + len(counts[0])), 0.5 * proof.max())
    strong = np.flatnonzero(proof > chance)  # picks only lower the evidence of the rest
    grams, other = [grams[i] for i in strong], other[strong]
    if not grams:
        return Counter()
    place = {g: i for i, g in enumerate(grams)}
    inside = [{u: [place[g] for g in _grams(u) if g in place] for u in bag} for bag in toxic]
    has = np.zeros((n1, len(grams)), np.float32)
    for d, bag in enumerate(inside):
        for own in bag.values():
            has[d, own] = 1
    weight = np.ones(n1, np.float32)
    found: Counter = Counter()
    for _ in range(picks):
        g = _evidence(weight @ has, n1, other, n0)
        best = int(g.argmax())
        if g[best] <= chance:
            break
        for d in np.flatnonzero(has[:, best]):
            hit = [u for u, own in inside[d].items() if best in own]
            for u in hit:
                del inside[d][u]
            found.update(u for u in hit if u not in known)
            has[d] = 0
            for own in inside[d].values():
                has[d, own] = 1
            weight[d] /= 2
    return found


def _distinct(texts: list[str], labels: list[int]) -> list[int]:
    """Places of the texts that are no near copies of earlier ones with their label: less
    than half of the six smallest hashes of their three-word shingles have been seen."""
    seen: set[tuple[int, int]] = set()
    out = []
    for i, (t, y) in enumerate(zip(texts, labels)):
        w = t.lower().split()
        hashes = {crc32(" ".join(w[k:k + 3]).encode("utf-8", "replace")) for k in range(max(1, len(w) - 2))}
        least = [(y, h) for h in heapq.nsmallest(6, hashes)]
        if 2 * sum(m in seen for m in least) < len(least):
            out.append(i)
        seen.update(least)
    return out


def _grams(unit: str) -> set[str]:
    s = f"^{unit}$"
    return {s[i:i + n] for n in (4, 5, 6) for i in range(len(s) - n + 1)} | ({s} if len(unit) < 9 else set())


def _svm(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 10.0) -> tuple[np.ndarray, float]:
    """Linear SVM with squared hinge loss by Newton steps with halving; y is -1 or 1."""
    xb = np.hstack([x, np.ones((len(x), 1))])
    reg = np.eye(xb.shape[1])
    reg[-1, -1] = 1e-4
    weight = c * weight / weight.mean()

    def loss(w: np.ndarray) -> float:
        return float(w @ reg @ w / 2 + (weight * np.maximum(0, 1 - y * (xb @ w)) ** 2).sum() / 2)

    w = np.zeros(xb.shape[1])
    now = loss(w)
    for _ in range(60):
        active = y * (xb @ w) < 1
        xa, wa = xb[active], weight[active]
        step = np.linalg.solve(reg + xa.T @ (xa * wa[:, None]), xa.T @ (wa * y[active])) - w
        size = 1.0
        while size > 1e-4 and loss(w + size * step) > now:
            size /= 2
        w = w + size * step
        before, now = now, loss(w)
        if before - now < 1e-7 * before:
            break
    return w[:-1], float(w[-1])


def train(texts: list[str], labels: list[int], landmarks: int = 32, order: int = 4, decay: float = 0.6,
          rounds: int = 3, pool: int = 60_000, shared_units: int = 50_000, odds: float | None = None,
          seed: int = 5) -> Model:
    """Model of labelled texts (1: toxic). With one label only, a constant model of its rate.

    ``odds`` are clean documents for each toxic one where the model is used; by
    default as in the texts.
    """
    none = Model([], np.zeros(0), -1.0, (0.0, 0.0, 0.0, -3.0), order, decay)
    alone = _distinct(texts, labels)
    bags = [set().union(*map(units, sentences(texts[i]))) for i in alone]
    labels = [labels[i] for i in alone]
    toxic = [b for b, y in zip(bags, labels) if y == 1 and b]
    clean = [b for b, y in zip(bags, labels) if y == 0 and b]
    if not toxic or not clean:
        return none
    rng = np.random.default_rng(seed)
    picked = _offensive(toxic, clean)
    if not picked:
        return none
    often: Counter = Counter()
    for bag in clean:
        often.update(bag)
    in_toxic: Counter = Counter()
    for bag in toxic:
        in_toxic.update(bag)
    shared = [u for u, k in sorted(often.items(), key=lambda p: (-p[1], p[0]))
              if k > 1 and in_toxic[u] / len(toxic) <= 2 * k / len(clean)][:shared_units]
    harmless = frozenset(shared)
    # Shared units are settled; the SVM is for those that no other document has.
    negatives = sorted(u for u in often if u not in harmless) or sorted(often)
    positives = [u for u, _ in sorted(picked.items(), key=lambda p: (-p[1], p[0]))][:2000]
    if len(negatives) > pool:
        negatives = [negatives[i] for i in np.sort(rng.choice(len(negatives), pool, replace=False))]

    def spread(words: list[str], n: int) -> list[str]:
        """Farthest-first choice under the kernel, from the first word on."""
        words = words[:400]
        probe = Model(words, np.zeros(len(words)), 0.0, (), order, decay)
        sim, chosen = probe.similar(words), [0]
        near = sim[:, 0].copy()
        while len(chosen) < min(n, len(words)):
            at = int(near.argmin())
            if near[at] > 0.95:
                break
            chosen.append(at)
            near = np.maximum(near, sim[:, at])
        return [words[i] for i in chosen]

    marks = spread(positives, landmarks * 3 // 5)
    rest = [u for u in negatives if len(u) > 2]
    probe = Model(marks, np.ones(len(marks)), 0.0, (), order, decay)
    close = probe.similar(rest).max(axis=1) if rest else np.zeros(0)
    hardest = [rest[i] for i in np.argsort(-close, kind="stable")[:400]]
    marks = list(dict.fromkeys(marks + spread(hardest, landmarks - len(marks)))) if hardest else marks
    model = Model(marks, np.zeros(len(marks)), 0.0, (), order, decay)
    gram = model.similar(marks).astype(float)
    value, vector = np.linalg.eigh((gram + gram.T) / 2)
    keep = value > 1e-3
    root = vector[:, keep] / np.sqrt(value[keep])
    all_neg = model.similar(negatives)
    noisy = positives + [_inserted(u, rng) for u in positives]
    some = np.unique(rng.choice(len(negatives), min(3000, len(negatives)), replace=False))
    for step in range(rounds):  # each time also against the clean units that look worst
        worst = np.argsort(-(all_neg @ model.beta) if step else -all_neg.max(axis=1), kind="stable")
        some = np.union1d(some, worst[:3000])
        pos = model.similar(noisy)
        x = np.vstack([pos, all_neg[some]]).astype(float) @ root
        y = np.r_[np.ones(len(pos)), -np.ones(len(some))]
        plus = np.array([min(picked[u], 50) for u in positives] * 2, float)
        weight = np.r_[plus * len(some) / plus.sum() / 2, np.ones(len(some))]
        theta, bias = _svm(x, y, weight)
        model = Model(marks, root @ theta, bias, (), order, decay, harmless)
    frequent = {u for u, k in picked.items() if k >= max(4, len(toxic) // 25)}
    weight = odds * len(toxic) / len(clean) if odds else 1.0
    return _calibrated(model, bags, labels, set(picked), frequent, weight)


def _inserted(unit: str, rng: np.random.Generator) -> str:
    """The unit with a sign between some of its letters, as evaders write it."""
    sign = "-.*_ "[rng.integers(5)]
    return "".join(c + (sign if rng.random() < 0.5 else "") for c in unit[:-1]) + unit[-1]


def _calibrated(model: Model, bags: list[set[str]], labels: list[int], picked: set[str],
                frequent: set[str], clean_weight: float) -> Model:
    """``model`` with a logistic curve through the documents' three highest values.

    A toxic document also counts once for each ``frequent`` offensive unit in it as
    if that were its only one, so that one clear insult is enough.
    """
    words = sorted(set().union(*bags))
    value = dict(zip(words, model.values(words).tolist()))
    rows = [(_top([value[u] for u in b], model.none), y, 1.0 if y == 1 else clean_weight) for b, y in zip(bags, labels)]
    for bag, y in zip(bags, labels):
        if y == 1 and (single := bag & frequent):
            rest = _top([value[u] for u in bag - picked], model.none)
            rows += [(sorted([value[u], *rest], reverse=True)[:3], 1, 1 / len(single)) for u in sorted(single)]
    x = np.array([[*r[0], 1.0] for r in rows])
    y, weight = np.array([r[1] for r in rows], float), np.array([r[2] for r in rows])
    w = np.zeros(4)
    ridge = np.diag([0.02, 0.02, 0.02, 1e-6])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(ridge + x.T @ (x * (weight * (p * (1 - p) + 1e-9))[:, None]),
                               x.T @ (weight * (y - p)) - ridge @ w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return Model(model.landmarks, model.beta, model.bias, tuple(w.tolist()), model.order, model.decay, model.clean)


def fit(docs: DataFrame, labels: DataFrame, per_label: int = 1500, max_bytes: int = 12_000) -> Model:
    """Model of the labelled rows that are not held out (crc32(doc_id) mod 5 is 0).

    At most ``per_label`` rows of each label are used, none of over ``max_bytes``
    bytes; null labels, ids and texts are passed over. Of these rows, training picks at most 80 n-grams as
    evidence, the 2,000 strongest offensive units, 60,000 clean ones, and landmarks from the 400 first and the 400
    clean units nearest to them; up to 50,000 units that clean documents share are settled as clean. These bounds
    concern the sample only: every unit of every text is scored.
    """
    keys = labels.where(~held_out("doc_id", 5, 0)).select("doc_id", "toxic")
    rows = sample_by_label(docs, keys, "toxic", per_label, max_bytes).toPandas()
    rows = rows.sort_values("doc_id")
    counts = {r["toxic"]: r["count"] for r in keys.groupBy("toxic").count().collect()}
    odds = counts.get(0, 0) / counts[1] if counts.get(1) else None
    return train(rows["text"].tolist(), rows["label"].tolist(), odds=odds)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1) of each whole text.

    Null and empty texts get the value of no unit at all (clean). Rows are judged
    one by one: repeats and other columns stay as they are; a column named
    toxicity is replaced. An empty table stays empty.
    """
    prepare(docs.sparkSession)

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(texts.to_pylist()), pa.float64())

    return docs.withColumn("toxicity", run(F.col("text")))

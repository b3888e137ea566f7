"""Language identification by mixture inference.

Byte n-grams of all labelled training texts are counted per language in one Spark
job, each by itself, so the counts grow with the text. A document is a mixture: expectation-maximisation over its words estimates
which proportion each language has, from the words' n-gram likelihoods. Languages
are dropped one by one while the penalised likelihood gains; the prediction is the
largest proportion of the set that stays.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import appended, held, held_out, prepare

GRAM = 4
_BLOCK = 1 << 20
#: Bytes that belong to words: letters of ASCII and all bytes of other characters.
_LETTER = np.array([chr(b).isalpha() and b < 128 or b >= 128 for b in range(256)])


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-gram, word number) of every n-gram, and the document of each word.

    A word is a run of letters with a blank on both sides; its n-grams are those of
    ``GRAM`` bytes within, and the whole of a shorter one. An n-gram's code is its bytes, so equal codes
    are equal n-grams.
    """
    flat = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    flat = np.concatenate([np.full(1, 32, np.uint8), flat, np.full(GRAM, 32, np.uint8)])
    ends = np.cumsum([len(t) + 1 for t in texts])
    letter = _LETTER[flat]
    low = np.where(letter, flat, 32)
    start = letter[1:] & ~letter[:-1]  # the blank before a word
    word = np.cumsum(start) - 1
    n = len(flat) - GRAM
    code = low[:n].astype(np.uint32)
    inside, word_goes_on = np.ones(n, bool), np.ones(n, bool)
    for k in range(1, GRAM):
        word_goes_on &= letter[k:n + k]
        code = (code << np.uint32(8)) | np.where(word_goes_on, low[k:n + k], 32).astype(np.uint32)
        if k < GRAM - 1:
            inside &= letter[k:n + k]
    begin = start[:n]
    use = (letter[:n] | begin) & (inside | begin)
    doc = np.searchsorted(ends, np.flatnonzero(start), side="right")
    return code[use], word[:n][use], doc


@dataclass
class Model:
    """``table`` holds log P(n-gram | language), one column for each of ``languages``: a row for each of
    ``codes``, the counted n-grams, and a last one for all others."""

    languages: list[str]
    codes: np.ndarray
    table: np.ndarray

    def __post_init__(self) -> None:
        """Cells of a hash table with an n-gram each; those whose cell is taken go to a sorted list."""
        bits = max(8, int(2 * len(self.codes)).bit_length())
        self.shift = np.uint32(32 - min(bits, 28))
        cell = self._cell(self.codes)
        owner = np.full(1 << int(32 - self.shift), -1, np.int32)
        taken, first = np.unique(cell, return_index=True)
        owner[taken] = first
        rest = np.setdiff1d(np.arange(len(self.codes)), first)
        rest = rest[np.argsort(self.codes[rest])]
        self.owner, self.rest, self.rest_codes = owner, rest, self.codes[rest]

    def _cell(self, code: np.ndarray) -> np.ndarray:
        return (code * np.uint32(0x9E3779B1)) >> self.shift

    def rows(self, code: np.ndarray) -> np.ndarray:
        """The row of each n-gram's own counts; the last row where it was never counted."""
        none = len(self.codes)
        at = self.owner[self._cell(code)]
        if none:
            other = np.flatnonzero(self.codes[at] != code)
            at[other[at[other] < 0]] = none
            other = other[at[other] != none]
            if len(self.rest) and len(other):
                near = np.minimum(np.searchsorted(self.rest_codes, code[other]), len(self.rest) - 1)
                at[other] = np.where(self.rest_codes[near] == code[other], self.rest[near], none)
            else:
                at[other] = none
        else:
            at[:] = none
        return at

    def infer(self, texts: list[str | None], rounds: int = 12,
              penalty: float = 2.0) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(prediction, score, proportions) of each text."""
        n, k = len(texts), len(self.languages)
        share = np.zeros((n, k))
        judged = np.array([bool(t) and any(map(str.isalpha, t)) for t in texts], bool)
        if k and judged.any():
            code, word, doc = grams([(t or "").lower().encode("utf-8", "replace") for t in texts])
            first = np.flatnonzero(np.r_[True, np.diff(word) > 0])
            like = np.add.reduceat(self.table[self.rows(code)], first) if len(code) else np.zeros((0, k), np.float32)
            doc = doc[word[first]] if len(code) else doc[:0]
            share = mixture(like, doc, n, rounds, penalty)
            share[~judged] = 0
            share[judged & (share.sum(axis=1) == 0)] = 1 / k  # letters, but no n-gram
        best = share.argmax(axis=1) if k else np.zeros(n, int)
        score = share[np.arange(n), best] if k else np.zeros(n)
        names = [self.languages[b] if k and j else "und" for b, j in zip(best, judged)]
        return names, score, share


def mixture(like: np.ndarray, doc: np.ndarray, n: int, rounds: int, penalty: float) -> np.ndarray:
    """Proportions (n, languages) of words with log likelihoods ``like`` in documents ``doc``
    (ascending); languages outside the chosen set have 0."""
    k = like.shape[1]
    share = np.zeros((n, k))
    if not len(doc):
        return share
    first = np.flatnonzero(np.r_[True, np.diff(doc) > 0])
    ids, words = doc[first], np.diff(np.r_[first, len(doc)])
    own = np.repeat(np.arange(len(ids)), words)
    peak = like.max(axis=1, keepdims=True)
    prob = np.exp(np.maximum(like - peak, -60)).astype(np.float32)

    def fit(pi: np.ndarray, times: int, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """EM for the documents ``of``: proportions and log likelihood (up to the words' peaks)."""
        rows = np.isin(own, of) if len(of) < len(ids) else slice(None)
        p = prob[rows]
        at = np.searchsorted(of, own[rows])
        cut = np.flatnonzero(np.r_[True, np.diff(at) > 0])
        pi = pi.astype(np.float32)
        for _ in range(times):
            r = p * pi[at]
            r /= r.sum(axis=1, keepdims=True) + 1e-30
            pi = np.add.reduceat(r, cut) / words[of][:, None].astype(np.float32)
        ll = np.add.reduceat(np.log((p * pi[at]).sum(axis=1) + 1e-30), cut)
        return pi, ll

    every = np.arange(len(ids))
    pi, ll = fit(np.full((len(ids), k), 1 / k), rounds, every)
    cost = penalty * np.log(words + 1.0)
    todo = every
    for _ in range(k - 1):
        here = pi[todo]
        active = here > 0
        go = active.sum(axis=1) > 1
        todo = todo[go]
        if not len(todo):
            break
        less = pi[todo].copy()
        drop = np.where(less > 0, less, 2).argmin(axis=1)
        less[np.arange(len(todo)), drop] = 0
        less /= less.sum(axis=1, keepdims=True)
        new, new_ll = fit(less, max(2, rounds // 4), todo)
        better = new_ll + cost[todo] >= ll[todo]
        pi[todo[better]], ll[todo[better]] = new[better], new_ll[better]
        todo = todo[better]
    share[ids] = pi
    return share


def _blocks(texts: list, limit: int = _BLOCK):
    """Slices of the list with about ``limit`` characters each."""
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size > limit or i == len(texts) - 1:
            yield slice(lo, i + 1)
            lo, size = i + 1, 0


def _added(counts: tuple[np.ndarray, np.ndarray] | None, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts (codes, numbers) with those of more n-grams."""
    own, n = np.unique(code, return_counts=True)
    if counts is None:
        return own, n
    both, at = np.unique(np.concatenate([counts[0], own]), return_inverse=True)
    return both, np.bincount(at, np.concatenate([counts[1], n])).astype(np.int64)


def model_of(languages: list[str], lang: np.ndarray, code: np.ndarray, n: np.ndarray) -> Model:
    """Model of counts: ``n`` times ``code`` in language number ``lang``; half an occurrence more for each n-gram."""
    codes, at = np.unique(code.astype(np.uint32), return_inverse=True)
    table = np.full((len(codes) + 1, len(languages)), 0.5)
    np.add.at(table, (at, lang), n)
    return Model(languages, codes, np.log(table / table.sum(axis=0)).astype(np.float32))


def fit(docs: DataFrame, most: int = 500_000) -> Model:
    """Model of the documents that are not held out (crc32(doc_id) mod 4 is 2).

    All n-grams of all their texts with a non-null lang are counted, each by itself, and all counts are
    kept. Partial counts leave a task whenever it holds ``most`` n-grams of a language. What reaches the driver is a row
    for each n-gram and language that occur: their number follows the alphabets (the letters of ASCII
    make at most 27 ** 4), not the number of documents.
    """
    prepare(docs.sparkSession, 2)
    rows = (docs.where(~held_out("doc_id", 4, 2) & F.col("lang").isNotNull() & F.col("text").isNotNull())
            .select("lang", "text"))

    def counts_of(lang: str, counts: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([lang] * len(counts[0]), pa.string()),
                                           pa.array(counts[0].astype(np.int64)), pa.array(counts[1])], ["lang", "code", "n"])

    def count(batches):
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            langs = np.array(b.column(0).to_pylist(), dtype=object)
            texts = b.column(1).to_pylist()
            for lang in sorted(set(langs)):
                own = [texts[i] for i in np.flatnonzero(langs == lang)]
                for s in _blocks(own):
                    code, _, _ = grams([t.lower().encode("utf-8", "replace") for t in own[s]])
                    total[lang] = _added(total.get(lang), code)
                    if len(total[lang][0]) >= most:
                        yield counts_of(lang, total.pop(lang))
        for lang, c in total.items():
            yield counts_of(lang, c)

    counts = (rows.mapInArrow(count, "lang string, code long, n long")
              .groupBy("lang", "code").agg(F.sum("n").alias("n")).toArrow())
    names = sorted(set(counts["lang"].unique().to_pylist()))
    number = {lang: i for i, lang in enumerate(names)}
    coded = counts["lang"].combine_chunks().dictionary_encode()
    lang = np.array([number[x] for x in coded.dictionary.to_pylist()], np.int64)[coded.indices.to_numpy()] \
        if len(counts) else np.zeros(0, np.int64)
    return model_of(names, lang, counts["code"].to_numpy(), counts["n"].to_numpy())


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``lang_pred``, ``lang_score`` (its proportion) and ``lang_shares``
    (language to proportion, for the chosen set).

    Null texts and texts without a letter get ``und`` with score 0, as does every
    text if nothing was learned; ties go to the first language by name. Rows are
    judged one by one: repeats and other columns stay; columns of these three names
    are replaced. An empty table stays empty.
    """
    prepare(docs.sparkSession, 2)

    @F.arrow_udf("struct<lang_pred: string, lang_score: double, lang_shares: map<string, double>>")
    def run(texts: pa.Array) -> pa.Array:
        held(("language",), dict)
        texts = texts.to_pylist()
        names, scores, shares = [], [], []
        for s in _blocks(texts):
            n, c, p = model.infer(texts[s])
            names += n
            scores += c.tolist()
            shares += [[(lang, v) for lang, v in zip(model.languages, row) if v > 0] for row in p.tolist()]
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(scores, pa.float64()),
             pa.array(shares, pa.map_(pa.string(), pa.float64()))],
            names=["lang_pred", "lang_score", "lang_shares"])

    return appended(docs, run(F.col("text")), ["lang_pred", "lang_score", "lang_shares"])

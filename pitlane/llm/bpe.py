"""Byte-level BPE encoding with a pair occurrence index, and decoding.

All pre-tokens of a partition's batch that have no ids yet are laid out in one array of
symbols. An index maps each adjacent pair that has a rank to all its positions there.
Active ranks are applied in ascending order, each to all its positions at once; the
pairs that a merge makes are added to the lists of their ranks. Whole texts are then put
together from the ids of their pre-tokens.
"""

from __future__ import annotations

import heapq
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import appended, held, prepare
from pitlane.llm.words import by_word, no_cycles

#: Words and pre-tokens a worker remembers; beyond, it starts anew (memory only, never results).
MEMO = 600_000
_SLICE = 1 << 16
_WALL = -1  # between pre-tokens: in no pair
_GONE = -2  # the right half of a merged pair
#: The byte-level pre-tokenizer's pattern (fixed), as it reads on ASCII; other text goes through the library's own.
_ASCII_PARTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)


class PairIndex:
    """The merges of a vocabulary, applied to many symbol sequences at once."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        """Merge k, of rank k, makes ``merged[k]`` of ``left[k]`` and ``right[k]``."""
        rank = np.arange(len(left))
        made = np.full(int(max(left.max(), right.max(), merged.max())) + 1, -1)
        made[merged] = rank
        if (made[left] >= rank).any() or (made[right] >= rank).any():
            raise ValueError("a merge uses a symbol that only a later merge makes")
        self.left, self.right, self.merged = (a.astype(np.int64) for a in (left, right, merged))
        keys = (self.left << 32) + self.right
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where it is no merge."""
        key = (a << 32) + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], -1)

    def apply(self, symbols: np.ndarray) -> np.ndarray:
        """``symbols`` (walls at both ends and between sequences) with all merges applied; merged-away ones left out."""
        sym = symbols.astype(np.int64)
        n = len(sym)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(at: np.ndarray) -> None:
            """Enter the pairs that start at ``at`` under their ranks."""
            rank = self.ranks(sym[at], sym[after[at]])
            found = np.flatnonzero(rank >= 0)
            if not len(found):
                return
            found = found[np.argsort(rank[found], kind="stable")]
            at, rank = at[found], rank[found]
            ends = np.r_[np.flatnonzero(rank[1:] != rank[:-1]) + 1, len(rank)].tolist()
            begin = 0
            for end in ends:
                r = int(rank[begin])
                if r not in index:
                    index[r] = []
                    heapq.heappush(active, r)
                index[r].append(at[begin:end])
                begin = end

        note(np.arange(n - 1))
        while active:
            r = heapq.heappop(active)
            lists = index.pop(r)  # no place is in two of them: symbols only grow
            p = lists[0] if len(lists) == 1 else np.concatenate(lists)
            a, b = self.left[r], self.right[r]
            p = p[(sym[p] == a) & (sym[after[p]] == b)]  # others have been merged with a neighbour meanwhile
            if a == b and len(p) > 1:  # in a run of equal symbols every other place, from the left
                p.sort()
                starts = np.r_[True, after[p[:-1]] != p[1:]]
                run = np.flatnonzero(starts)[np.cumsum(starts) - 1]
                p = p[(np.arange(len(p)) - run) % 2 == 0]
            if not len(p):
                continue
            q = after[p]
            beyond = after[q]
            new = self.merged[r]
            sym[p], sym[q] = new, _GONE
            after[p] = beyond
            before[beyond] = p
            left = before[p]
            note(np.concatenate([left[sym[left] != new], p]))
        return sym[sym != _GONE]


def _byte_signs() -> list[str]:
    """The sign that stands for each byte in byte-level vocabularies: itself if it is printable in Latin-1,
    else the next code point from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class PairEncoder:
    """Encoder and decoder of one byte-level BPE file of the ``tokenizers`` library."""

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        with open(file, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
               if model.get(k)]
        if odd or spec["normalizer"] or any((spec[k] or {}).get("type") != "ByteLevel" for k in ("pre_tokenizer", "decoder")):
            raise ValueError(f"no plain byte-level BPE: {file}")
        added = spec["added_tokens"]
        if any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized")) or any(
                t["content"].isalpha() or re.search(r"\s", t["content"]) for t in added):
            raise ValueError("added tokens that look at their neighbours, hold white space or letters alone")
        vocab: dict[str, int] = model["vocab"]
        self.added = {t["content"]: t["id"] for t in added}
        self.parted = re.compile("|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) or r"(?!)")
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.index = PairIndex(*(np.array([vocab[t] for t in side]) for side in
                                 ([a for a, _ in pairs], [b for _, b in pairs], [a + b for a, b in pairs])))
        self.pre = Tokenizer.from_file(file).pre_tokenizer.pre_tokenize_str
        signs = _byte_signs()
        if any(s not in vocab for s in signs):
            raise ValueError("a byte without a symbol")
        self.first = np.array([vocab[s] for s in signs])  # a byte's symbol
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        raw = {s: bytes([b]) for b, s in enumerate(signs)}
        of = [b""] * size
        for t, i in (vocab | self.added).items():
            of[i] = b"".join(raw[c] for c in t) if all(c in raw for c in t) else t.encode()
        self.blob = np.frombuffer(b"".join(of), np.uint8)
        self.sizes = np.fromiter(map(len, of), np.int64, size)
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _merged(self, parts: list[str]) -> list[bytes]:
        """Ids of each pre-token, all through one index."""
        raw = [p.encode() for p in parts]
        length = np.fromiter(map(len, raw), np.int64, len(raw))
        walls = np.r_[0, np.cumsum(length)] + np.arange(len(raw) + 1)
        symbols = np.full(int(length.sum()) + len(raw) + 1, _WALL, np.int64)
        inside = np.ones(len(symbols), bool)
        inside[walls] = False
        symbols[inside] = self.first[np.frombuffer(b"".join(raw), np.uint8)]
        done = self.index.apply(symbols)
        walls = np.flatnonzero(done == _WALL) * self.dtype.itemsize
        ids = done.astype(self.dtype).tobytes()
        size = self.dtype.itemsize
        return [ids[i + size:j] for i, j in zip(walls[:-1].tolist(), walls[1:].tolist())]

    def _cut(self, span: str) -> list[str]:
        """The pre-tokens of a span without added tokens."""
        return _ASCII_PARTS.findall(span) if span.isascii() else [span[i:j] for _, (i, j) in self.pre(span)]

    def _resolved(self, spans: list[str], whole: list[str]) -> list[bytes]:
        """Ids of spans of text without added tokens, and of those that are one pre-token each."""
        known = self.parts
        if len(known) > MEMO:
            known.clear()
        cut = [self._cut(s) for s in spans]
        new = list({p for c in cut for p in c if p not in known})
        done = self._merged(new + whole)
        known.update(zip(new, done))
        return [b"".join([known[p] for p in c]) for c in cut] + done[len(new):]

    def whole(self, text: str) -> bytes:
        """Ids of a text that can't be taken word by word."""
        out, at = [], 0
        for m in [*self.parted.finditer(text), None]:
            end = m.start() if m else len(text)
            out += self._resolved([text[at:end]], []) if end > at else []
            if m:
                out.append(np.array([self.added[m.group()]], self.dtype).tobytes())
                at = m.end()
        return b"".join(out)

    def _alone(self, word: str) -> bool:
        """A word whose pre-tokens don't depend on what is beside its spaces."""
        return bool(word) and not (word[0].isspace() or word[-1].isspace()) and self.parted.search(word) is None

    def lookup(self, words: list[str]) -> list[bytes | None]:
        """Ids of each word after a space; None for such as depend on their neighbours."""
        memo = self.words
        if len(memo) > MEMO:
            memo.clear()
        new = [w for w in words if w not in memo]
        plain = [w for w in new if w.isascii() and w.isalpha()]
        known = set(plain)
        mixed = [w for w in new if w not in known and self._alone(w)]
        done = dict(zip(mixed + plain, self._resolved([" " + w for w in mixed], [" " + w for w in plain])))
        memo.update((w, i) for w, i in done.items() if "\n" not in w)  # two lines' words seldom meet again
        return [memo[w] if w in memo else done.get(w) for w in words]

    def opening(self, words: list[str]) -> list[bytes | None]:
        """Ids of each word at a text's start."""
        new = [w for w in dict.fromkeys(words) if self._alone(w)]
        done = dict(zip(new, self._resolved(new, [])))
        return [done.get(w) for w in words]

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """The list of ids of each text; null and empty texts have none."""
        with no_cycles():
            coded = by_word(texts, self.lookup, self.dtype, self.whole, self.opening)
        ends = np.frombuffer(coded.buffers()[1], np.int64)[:len(coded) + 1] if len(coded) and coded.buffers()[2] is not None \
            else np.zeros(len(coded) + 1, np.int64)
        ids = np.frombuffer(coded.buffers()[2], self.dtype)[:ends[-1] // self.dtype.itemsize] if ends[-1] \
            else np.zeros(0, self.dtype)
        return pa.ListArray.from_arrays(pa.array((ends // self.dtype.itemsize).astype(np.int32)), pa.array(ids.astype(np.int32)))

    def decode(self, lists: pa.ListArray) -> pa.Array:
        """The text of each list of ids; bytes that are no UTF-8 become replacement signs."""
        at = lists.offsets.to_numpy()
        ids = lists.flatten().to_numpy()
        size = self.sizes[ids]
        ends = np.r_[0, np.cumsum(size)]
        out = np.empty(ends[-1], np.uint8)
        for lo in range(0, len(ids), _SLICE):  # the places of all bytes at once would take far more than the bytes
            own = ids[lo:lo + _SLICE]
            begin, end = ends[lo], ends[lo + len(own)]
            out[begin:end] = self.blob[np.repeat(self.begin[own] - ends[lo:lo + len(own)], size[lo:lo + len(own)])
                                       + np.arange(begin, end)]
        raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lists),
                                               [None, pa.py_buffer(ends[at - at[0]].astype(np.int64)), pa.py_buffer(out)])
        try:
            return raw.cast(pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:
            return pa.array([b.decode("utf-8", "replace") for b in raw.to_pylist()], pa.string())


def encoder(file: str) -> PairEncoder:
    """The worker's encoder of ``file``."""
    return held(("pairs", file), lambda: PairEncoder(file))


def coded(docs: DataFrame, file: str) -> DataFrame:
    """``docs`` with ``ids`` (array of int, as the library's encoding without special tokens added,
    truncation or padding) and ``decoded``, the text that these ids give, special tokens kept.

    Null and empty texts have no ids and decode to an empty text. An added token's own string inside a text
    becomes that token, as in the library. Each row is coded by itself: repeated rows and all other columns
    stay as they are; columns named ids or decoded (in any case) are replaced. An empty table stays empty.
    """
    prepare(docs.sparkSession)

    @F.arrow_udf("struct<ids: array<int>, decoded: string>")
    def run(texts: pa.Array) -> pa.Array:
        enc = encoder(file)
        ids = enc.encode(texts)
        return pa.StructArray.from_arrays([ids, enc.decode(ids)], names=["ids", "decoded"])

    return appended(docs, run(F.col("text")), ["ids", "decoded"])

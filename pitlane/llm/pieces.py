"""SentencePiece merge-type encoding by backtracking, and decoding.

The greedy merge result of a text is the one sequence of pieces in which every
adjacent pair stays apart when its two texts are merged again. It is found from
left to right: longest matches come from an Aho-Corasick automaton, a pair is
checked by re-merging it, a position from which no compatible piece leads on is
marked in a bit field and the last piece is shortened.
"""

from __future__ import annotations

import heapq
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import appended, held, prepare
from pitlane.llm.words import by_word, no_cycles

SPACE = "▁"
#: Words and pairs a worker remembers; beyond, it starts anew (memory only, never results).
MEMO = 500_000
_UNITS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


class MergeEncoder:
    """Encoder and decoder of one merge-type model with byte fallback and identity normalizing."""

    def __init__(self, file: str):
        import sentencepiece
        sp = self.sp = sentencepiece.SentencePieceProcessor(model_file=file)
        self.ids: dict[str, int] = {}
        self.bytes = [0] * 256
        for i in range(sp.vocab_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(p[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[p] = i
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            raise ValueError("pieces reach over a word's start; texts can't be split there")
        self.score = {p: sp.get_score(i) for p, i in self.ids.items()}
        self.chars = frozenset(c for p in self.ids for c in p)
        self.pairs: dict[tuple[str, str], bool] = {}
        self.memo: dict[str, bytes] = {}
        self.newline = np.array([self.bytes[10]], "<u4").tobytes()
        self.match = ahocorasick.Automaton()
        self.shorter: dict[str, str | None] = {}
        for p in self.ids:
            if len(p) == 1 or self.merge(p) == [p]:  # others never come out of merging
                self.match.add_word(p, p)
        self.match.make_automaton()

    def merge(self, text: str) -> list[str]:
        """Merge the adjacent pair of the best score (leftmost of equals) while any is a piece."""
        sym: list[str] = list(text)
        n = len(sym)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        queue: list[tuple] = []

        def offer(i: int) -> None:
            j = right[i]
            if j < n and (s := self.score.get(sym[i] + sym[j])) is not None:
                heapq.heappush(queue, (-s, i, sym[i], sym[j]))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, i, a, b = heapq.heappop(queue)
            j = right[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue  # one of the two has been merged meanwhile
            sym[i], sym[j] = a + b, ""
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            if left[i] >= 0:
                offer(left[i])
            offer(i)
        return [s for s in sym if s]

    def compatible(self, a: str, b: str) -> bool:
        """Whether the two pieces stay as they are when merged anew."""
        ok = self.pairs.get((a, b))
        if ok is None:
            if len(self.pairs) > MEMO:
                self.pairs.clear()
            ok = self.pairs[a, b] = self.merge(a + b) == [a, b]
        return ok

    def prefix(self, piece: str) -> str | None:
        """The longest piece that is a proper prefix."""
        if piece not in self.shorter:
            self.shorter[piece] = next((piece[:k] for k in range(len(piece) - 1, 0, -1)
                                        if piece[:k] in self.match), None)
        return self.shorter[piece]

    def backtrack(self, text: str) -> list[str]:
        """The pieces of ``text``, all of whose characters are pieces."""
        n = len(text)
        longest: list[str | None] = [None] * n
        for end, p in self.match.iter(text):
            at = end - len(p) + 1
            if longest[at] is None or len(longest[at]) < len(p):
                longest[at] = p
        failed = bytearray(n + 1)
        out: list[str] = []
        at, piece = 0, longest[0]
        while at < n:
            while piece is not None and (failed[at + len(piece)]
                                         or out and not self.compatible(out[-1], piece)):
                piece = self.prefix(piece)
            if piece is not None:
                out.append(piece)
                at += len(piece)
                piece = longest[at] if at < n else None
            elif out:
                failed[at] = 1
                last = out.pop()
                at -= len(last)
                piece = self.prefix(last)
            else:
                raise ValueError(f"no encoding of {text[:40]!r}")
        return out

    def unit(self, u: str) -> bytes:
        """Ids of one word (with the space signs before it)."""
        ids: list[int] = []
        spans = [(True, u)]
        if not self.chars.issuperset(u):  # characters without a piece never merge: they part the word
            spans, run = [], ""
            for c in u:
                if c in self.chars:
                    run += c
                    continue
                if run:
                    spans.append((True, run))
                spans.append((False, c))
                run = ""
            if run:
                spans.append((True, run))
        for known, s in spans:
            if not known:
                ids += [self.bytes[b] for b in s.encode()]
            elif s.startswith(SPACE * 2):  # pieces of spaces have equal scores: merge directly
                for p in self.merge(s):
                    ids += [self.ids[p]] if p in self.ids else [self.bytes[b] for b in p.encode()]
            else:
                ids += [self.ids[p] for p in self.backtrack(s)]
        return np.array(ids, "<u4").tobytes()

    def whole(self, text: str) -> bytes:
        return b"".join(map(self.unit, _UNITS.findall(SPACE + text.replace(" ", SPACE))))

    def lookup(self, words: list[str]) -> list[bytes | None]:
        """Ids of each word after a space; None beside another space or a space sign."""
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        out: list[bytes | None] = []
        for w in words:
            ids = memo.get(w)
            if ids is None and w and SPACE not in w:
                if "\n" in w and "\n" not in self.chars:  # a line break parts the word: remember the lines
                    first, *rest = w.split("\n")
                    ids = self.newline.join([self.kept(first or " ", SPACE + first)]
                                            + [self.kept(" " + x, x) if x else b"" for x in rest])
                else:
                    ids = memo[w] = self.unit(SPACE + w)
            out.append(ids)
        return out

    def kept(self, key: str, unit: str) -> bytes:
        ids = self.memo.get(key)
        if ids is None:
            ids = self.memo[key] = self.unit(unit)
        return ids

    def encode(self, texts: pa.Array) -> pa.Array:
        """Ids of whole texts with begin and end id, as little-endian unsigned 32-bit."""
        head, tail = (np.array([i], "<u4").tobytes() for i in (self.sp.bos_id(), self.sp.eos_id()))
        with no_cycles():
            return by_word(texts, self.lookup, np.dtype("<u4"), self.whole, None, head, tail)

    def decode(self, ids: bytes) -> str:
        return self.sp.decode(np.frombuffer(ids, "<u4").tolist())


def encoder(file: str) -> MergeEncoder:
    """The worker's encoder of ``file``."""
    return held(("pieces", file), lambda: MergeEncoder(file))


def coded(docs: DataFrame, file: str) -> DataFrame:
    """``docs`` with ``ids`` (binary, little-endian unsigned 32-bit, begin and end id
    included) and ``decoded``, the text that these ids give.

    Null and empty texts have the begin and end id alone and decode to an empty
    text. Each row is coded by itself, so repeats, other columns and nulls in them
    stay as they are; columns named ids or decoded are replaced.
    """
    prepare(docs.sparkSession)

    @F.arrow_udf("struct<ids: binary, decoded: string>")
    def run(texts: pa.Array) -> pa.Array:
        enc = encoder(file)
        ids = enc.encode(texts)
        return pa.StructArray.from_arrays(
            [ids.cast(pa.binary()), pa.array([enc.decode(i) for i in ids.to_pylist()], pa.string())],
            names=["ids", "decoded"])

    return appended(docs, run(F.col("text")), ["ids", "decoded"])

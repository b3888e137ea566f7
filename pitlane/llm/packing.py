"""Concatenate-and-cut packing: token ids of all documents in windows of fixed length.

Pass one tokenizes each document once and writes its ids with its place in its
partition; the partitions' token totals, one row each, are prefix-summed into
offsets. Pass two adds the offset of its partition to each document and cuts its
ids at the window borders into boundary records. Neither pass shuffles texts or ids.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import held, prepare, stored
from pitlane.llm.words import by_word, no_cycles

#: Words a worker remembers; beyond, it starts anew (memory only, never results).
MEMO = 900_000
#: Signs that no rule of the pre-tokenizer joins with letters before them.
_SIGNS = ".,;:!?*&$%#"


class ChunkEncoder:
    """Ids of whole texts from a byte-level BPE file of the ``tokenizers`` library.

    A single space between two other characters that are not white space always
    starts a new pre-token, so a text is encoded word by word there, each distinct
    word once. Texts with other white space beside a space are encoded whole.
    """

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(file)
        small = self.tokenizer.get_vocab_size() <= 1 << 16
        self.code, self.dtype = ("H", np.dtype("u2")) if small else ("I", np.dtype("u4"))
        self.memo: dict[str, bytes] = {}
        self.signs: dict[str, bytes] = {}
        self.newline = self.whole("\n")

    def whole(self, text: str) -> bytes:
        return array(self.code, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _batch(self, texts: list[str]) -> list[bytes]:
        code = self.code
        return [array(code, e.ids).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _sign(self, end: str) -> bytes:
        if end not in self.signs:
            self.signs[end] = self.whole(end)
        return self.signs[end]

    def lookup(self, words: list[str]) -> list[bytes | None]:
        """Ids of each word after a space; None beside other white space.

        Words with a line break or with signs at their end are put together from
        parts, as both are pre-tokens of their own. Keys that start with a blank stand
        for words at a line's start.
        """
        memo = self.memo
        if len(memo) > MEMO:
            memo.clear()
        need: set[str] = set()
        ended: list[tuple[str, str]] = []  # words with signs at their end, and their letters
        lines: dict[str, list[tuple[str, str]]] = {}
        for w in [w for w in words if w not in memo]:
            if w.isalpha():
                need.add(w)
            elif not w or w[0].isspace() or w[-1].isspace():
                continue
            elif "\n" in w and not any(not x or x[0].isspace() or x[-1].isspace() for x in w.split("\n")):
                first, *rest = w.split("\n")
                lines[w] = [self._parted(x) for x in (first, *(" " + x for x in rest))]
                need.update(s for s, _ in lines[w] if s not in memo)
            else:
                stem, end = self._parted(w)
                if end:
                    ended.append((w, stem))
                if stem not in memo:
                    need.add(stem)
        new = list(need)
        memo.update(zip(new, self._batch([k[1:] if k[0] == " " else " " + k for k in new])))
        sign, newline = self._sign, self.newline
        memo.update([(w, memo[s] + sign(w[len(s):])) for w, s in ended])
        joined = {w: newline.join([memo[s] + sign(e) if e else memo[s] for s, e in own])
                  for w, own in lines.items()}  # not remembered: lines seldom come again
        out = list(map(memo.get, words))
        if joined:
            out = [joined.get(w) if i is None else i for w, i in zip(words, out)]
        return out

    @staticmethod
    def _parted(word: str) -> tuple[str, str]:
        """The word's letters and the signs after them; a word of another kind whole."""
        stem = word.rstrip(_SIGNS)
        return (stem, word[len(stem):]) if stem.lstrip(" ").isalpha() else (word, "")

    def first(self, words: list[str]) -> list[bytes | None]:
        """Ids of each word at a text's start."""
        done = self._batch(words)
        return [None if not w or w[-1].isspace() else i for w, i in zip(words, done)]

    def encode(self, texts: pa.Array, tail: bytes = b"") -> pa.Array:
        """Ids of each text and then ``tail``, as bytes of ``dtype``."""
        with no_cycles():
            return by_word(texts, self.lookup, self.dtype, self.whole, self.first, tail=tail)


def encoder(file: str) -> ChunkEncoder:
    """The worker's encoder of ``file``."""
    return held(("chunks", file), lambda: ChunkEncoder(file))


def _tokenized(docs: DataFrame, file: str, end_id: int) -> DataFrame:
    """(doc_id, part, at, ids): ids end with ``end_id``; ``at`` counts ids before in the partition."""

    def run(batches):
        enc = encoder(file)
        end = np.array([end_id], enc.dtype).tobytes()
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            ids = enc.encode(b.column(1), end)
            n = pc.binary_length(ids).to_numpy().astype(np.int64) // enc.dtype.itemsize
            start = at + np.cumsum(n) - n
            at += int(n.sum())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.full(len(n), part)), pa.array(start),
                 pa.array(np.full(len(n), enc.dtype.itemsize)), ids.cast(pa.binary())],
                ["doc_id", "part", "at", "width", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, part long, at long, width long, ids binary")


def packed(docs: DataFrame, file: str, length: int = 1024, end_id: int = 0) -> DataFrame:
    """Pieces of the windows that hold all ids of ``docs`` without gaps.

    One row per piece: doc_id, start (ids of its document before it), length, ids
    (binary, little-endian unsigned 32-bit), doc_tokens, sequence_id, offset (in the
    sequence) and padded_length: the window length, but for a last sequence whose
    own length is a power of two, which stays as it is. Null texts count as empty,
    so every row, also with a null doc_id, has at least ``end_id``; repeated rows are
    packed once each. An empty table gives no pieces.
    """
    spark = docs.sparkSession
    prepare(spark)
    ids = stored(_tokenized(docs, file, end_id), "token-ids")
    # One row per input split, whatever the data: the offsets are bounded by the partitions.
    totals = [(r["part"], r["n"]) for r in
              ids.groupBy("part").agg(F.sum(F.octet_length("ids") / F.col("width")).cast("long").alias("n"))
              .orderBy("part").collect()]
    offsets, total = [], 0
    for part, n in totals:
        offsets.append((part, total))
        total += n
    last = total % length
    tail = last if last and last & (last - 1) == 0 else length
    bases = spark.createDataFrame(offsets, "part long, base long")
    placed = (ids.join(F.broadcast(bases), "part")
              .select("doc_id", (F.col("base") + F.col("at")).alias("first"), "width", "ids"))

    def cut(batches):
        for b in batches:
            if not b.num_rows:
                continue
            first, width, raw = b.column(1).to_numpy(), b.column(2)[0].as_py(), b.column(3).cast(pa.large_binary())
            ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1]
            ids = np.frombuffer(raw.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(f"u{width}").astype("<u4")
            tokens = np.diff(ends) // width
            count = (first + tokens - 1) // length - first // length + 1  # every document has an end id at least
            doc = np.repeat(np.arange(len(tokens)), count)
            seq = first[doc] // length + np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            start = np.maximum(seq * length - first[doc], 0)
            size = np.minimum((seq + 1) * length - first[doc], tokens[doc]) - start
            places = np.r_[0, np.cumsum(size)].astype(np.int64) * 4  # pieces follow each other as the ids do
            pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(doc),
                                                      [None, pa.py_buffer(places), pa.py_buffer(ids)])
            pad = np.where((seq + 1) * length > total, tail, length)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(doc)), pa.array(start), pa.array(size), pieces.cast(pa.binary()),
                 pa.array(tokens[doc]), pa.array(seq), pa.array(first[doc] + start - seq * length), pa.array(pad)], names)

    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", "padded_length"]
    return placed.mapInArrow(cut, ", ".join(f"{n} {'binary' if n == 'ids' else 'long'}" for n in names))

"""Ranked lexical search with range-maximum tables over posting lists.

One pass over the texts keeps, per document, its length and how often it holds each
query term; corpus figures are aggregated from these rows. Each task then indexes its
documents block by block: posting lists of integer impacts and, over them, a sparse
table of range maxima. A query walks a block best-first: an interval of documents is
bounded by the sum of its terms' range maxima, the best intervals are split at the document
of the largest impact, that document is scored exactly, and what can't reach the k-th best
score so far is left. Only the k best of each query leave a task.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitlane.llm.common import prepare, stored

#: Bytes that part terms become blanks, A-Z become a-z; all others stay (fixed by the query's definition).
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_LAST = np.iinfo(np.int64).max


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a whole text in order, in UTF-8."""
    return text.encode().translate(_FOLD).split() if text else []


def weight(n_docs: int, df: int) -> int:
    """A term's weight from the number of documents with a term and of those that hold it."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Block:
    """Posting lists of some documents with a sparse table of range maxima over their impacts.

    ``doc``, ``slot`` and ``impact`` are parallel arrays, one entry per posting; documents are
    numbered in the order in which ties are broken.
    """

    def __init__(self, n_docs: int, doc: np.ndarray, slot: np.ndarray, impact: np.ndarray):
        key = slot.astype(np.int64) * (n_docs + 1) + doc
        order = np.argsort(key)
        self.n_docs, self.key = n_docs, key[order]
        self.doc, self.impact = doc[order].astype(np.int64), np.r_[impact[order], 0]
        self.slots = np.unique(slot)
        n = len(self.key)
        most = int(np.bincount(slot).max(initial=0)) if n else 0
        best = np.arange(n, dtype=np.int32)  # level k: where the largest of the 2**k postings from here on is
        self.table = [best]
        while 2 << (len(self.table) - 1) <= most:
            half = 1 << (len(self.table) - 1)
            ahead = np.r_[best[half:], best[n - half:]]
            best = np.where(self.impact[ahead] > self.impact[best], ahead, best)
            self.table.append(best)
        self.table = np.stack(self.table)

    def spans(self, slots: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Postings [a, b) of every slot (rows) in every interval [low, high) of documents (columns)."""
        base = (slots.astype(np.int64) * (self.n_docs + 1))[:, None]
        return np.searchsorted(self.key, base + low), np.searchsorted(self.key, base + high)

    def scores(self, slots: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """The exact score of each document: the sum of its impacts for all slots."""
        key = (slots.astype(np.int64) * (self.n_docs + 1))[:, None] + doc
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.impact[at], 0).sum(axis=0)

    def largest(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Where the largest impact of postings [a, b) is, -1 for none."""
        n = b - a
        level = np.frexp(np.maximum(n, 1))[1] - 1
        full = n > 0
        a0, b0 = np.where(full, a, 0), np.where(full, b - (1 << level), 0)
        one, two = self.table[level, a0], self.table[level, b0]
        return np.where(full, np.where(self.impact[two] > self.impact[one], two, one), -1)


def search(block: Block, slots: np.ndarray, k: int, ids: np.ndarray, floor: tuple[int, int] | None,
           wave: int = 64, numbers: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of the k best documents of ``block`` for the terms ``slots``, best first.

    Documents without any of the terms never come up. With ``floor`` (score, id) only documents before it,
    by score and then by smaller id, need to be found. Up to ``wave`` intervals are split
    at once, fewer where that would take more than ``numbers`` range queries.
    """
    slots = slots[np.isin(slots, block.slots)]
    found_doc, found_score = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(slots) or not block.n_docs:
        return found_doc, found_score
    at_once = max(1, min(wave, numbers // len(slots)))
    low, high = np.zeros(1, np.int64), np.full(1, block.n_docs)
    bound = np.full(1, _LAST)
    split = np.full(1, -1)  # not yet known
    while len(low):
        if floor is not None:
            reach = (bound > floor[0]) | ((bound == floor[0]) & (ids[low] < floor[1]))
            low, high, bound, split = low[reach], high[reach], bound[reach], split[reach]
            if not len(low):
                break
        if len(low) > at_once:
            first = np.argpartition(-bound, at_once - 1)
            now, later = first[:at_once], first[at_once:]
        else:
            now, later = np.arange(len(low)), np.zeros(0, np.int64)
        known = split[now] >= 0
        at = now[known]
        if len(at):  # the best intervals' documents of largest impact, scored by all terms
            doc = split[at]
            score = block.scores(slots, doc)
            doc, score = np.r_[found_doc, doc], np.r_[found_score, score]
            best = np.lexsort((doc, -score))[:k]
            found_doc, found_score = doc[best], score[best]
            if len(best) == k:
                last = (int(found_score[-1]), int(ids[found_doc[-1]]))
                if floor is None or last[0] > floor[0] or last[0] == floor[0] and last[1] < floor[1]:
                    floor = last
        new = now[~known]
        part_low = np.concatenate([low[at], split[at] + 1, low[new]])
        part_high = np.concatenate([split[at], high[at], high[new]])
        some = part_low < part_high
        part_low, part_high = part_low[some], part_high[some]
        most = block.largest(*block.spans(slots, part_low, part_high))
        impact = np.where(most >= 0, block.impact[most], 0)
        part_bound = impact.sum(axis=0)
        part_split = block.doc[most[impact.argmax(axis=0), np.arange(len(part_low))]]
        some = part_bound > 0
        low, high = np.concatenate([low[later], part_low[some]]), np.concatenate([high[later], part_high[some]])
        bound, split = np.concatenate([bound[later], part_bound[some]]), np.concatenate([split[later], part_split[some]])
    return found_doc, found_score


def _counted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tfs): a document's number of terms and its counts of the vocabulary's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, ends, terms, tfs = [], [0], [], []
            for text in b.column(1).to_pylist():
                words = terms_of(text)
                n.append(len(words))
                for t, tf in Counter(words).items():
                    s = vocabulary.get(t)
                    if s is not None:
                        terms.append(s)
                        tfs.append(tf)
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                 pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int32()))], ["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n long, terms array<int>, tfs array<int>")


def _ranked(docs: DataFrame, queries: list[tuple[int, list[bytes]]], k: int, postings: int) -> DataFrame:
    """(query, doc_id, score): the k best documents of every task for each query (its number and its terms)."""
    spark = docs.sparkSession
    vocabulary: dict[bytes, int] = {}
    asked = [(q, np.array(sorted({vocabulary.setdefault(t, len(vocabulary)) for t in terms}), np.int64))
             for q, terms in queries]
    counts = stored(_counted(docs, vocabulary), "term-counts")
    total = counts.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = total["docs"], total["terms"] or 0
    weights = np.zeros(len(vocabulary), np.int64)  # terms in no document keep 0 and have no postings
    # At most one row per term of these queries, whatever the documents.
    for r in counts.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).toLocalIterator():
        weights[r["t"]] = weight(n_docs, r["df"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # query -> ids, scores, best first

        def searched(held: list[pa.RecordBatch]) -> None:
            t = pa.Table.from_batches(held).combine_chunks()
            ids = t["doc_id"].fill_null(_LAST).to_numpy()
            order = np.argsort(ids, kind="stable")
            place = np.empty(len(ids), np.int64)
            place[order] = np.arange(len(ids))
            ids, n = ids[order], t["n"].to_numpy()
            lists = t["terms"].combine_chunks()
            row = np.repeat(np.arange(len(n)), np.diff(lists.offsets.to_numpy()))
            slot, tf = lists.flatten().to_numpy(), t["tfs"].combine_chunks().flatten().to_numpy().astype(np.int64)
            m = 100 - 90 + (90 * n * n_docs) // n_terms
            impact = weights[slot] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[row]))
            block = Block(len(n), place[row], slot, impact)
            for q, slots in asked:
                old_ids, old = best.get(q, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                floor = (int(old[-1]), int(old_ids[-1])) if len(old) == k else None
                doc, score = search(block, slots, k, ids, floor)
                if len(doc):
                    new_ids, score = np.r_[old_ids, ids[doc]], np.r_[old, score]
                    top = np.lexsort((new_ids, -score))[:k]
                    best[q] = new_ids[top], score[top]

        held, size = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            size += len(b.column(2).flatten())
            if size >= postings:
                searched(held)
                held, size = [], 0
        if size:
            searched(held)
        for q, (ids, score) in best.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), q)), pa.array(ids, mask=ids == _LAST), pa.array(score)],
                ["query", "doc_id", "score"])

    return counts.mapInArrow(run, "query long, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, k: int = 10, postings: int = 1 << 20, block_bytes: int = 4 << 20,
           batch_mb: int = 4) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents of the highest positive scores for each item.

    Terms are runs of digits, ASCII letters (case folded) and characters beyond ASCII. With N documents that
    have a term, L terms in all and n in a document, df documents holding a term and tf times in this one, a
    term weighs w = floor(1000 ln((2N+2) / (2df+1))) and a document scores the sum of
    w * (10**9 tf div (1000 tf + 8 m)), m = 10 + (90 n N div L), over the item's distinct terms.

    Equal scores go by ascending doc_id, null ids last. Each row of ``items`` is an item of its own, also with
    a null or repeated id, and each row of ``docs`` a document of its own. Null texts and texts without
    terms are found by nothing and find nothing; empty tables give an empty result. Other columns are not read.
    Items are a stated query set: they are taken in blocks of ``block_bytes`` of text, one pass each;
    ``postings`` bounds what a task indexes at once.
    """
    spark = docs.sparkSession
    prepare(spark, batch_mb)
    asked = stored(items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text"))
                   .withColumn("query", F.monotonically_increasing_id()), "items")  # the numbers are fixed from here on
    found = None
    block: list[tuple[int, list[bytes]]] = []
    size = 0

    def flush() -> None:
        nonlocal found, block, size
        part = _ranked(docs, block, k, postings)
        found = part if found is None else found.unionByName(part)
        block, size = [], 0

    for r in asked.toLocalIterator():
        terms = list(dict.fromkeys(terms_of(r["text"])))
        if terms:
            block.append((r["query"], terms))
            size += len(r["text"])
            if size >= block_bytes:
                flush()
    if block:
        flush()
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    w = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    best = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return best.join(asked.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")

"""Exact top-k inner products with norm buckets.

Vectors are dealt once to ranges of their length, longest first, and stay there. The longest ones, a
bounded number, give every query a score that its k-th best reaches at least. Queries then go in blocks of bounded
size to all ranges; a task cuts its vectors into buckets of similar length, and from the query's score follows for each
bucket a local cosine threshold: a bucket whose longest vector can't reach the score is skipped; in the others the
candidates are cut either by length or, where the threshold is high, by the ranges that it leaves for the query's largest
coordinates. All that stay are verified by their products, and a task returns the k best of each query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitlane.llm.common import prepare, scratch, stored, tasks
from pitlane.llm.forest import usable
from pitlane.llm.negatives import whole

#: From this local cosine threshold on, coordinates cut more than they cost.
COORDINATES_FROM = 0.6
FOCUS = 4
#: Scores beyond 64 bits are held at this size; returning one is an error.
BEYOND = np.iinfo(np.int64).max
#: The floor of a query that no score is known for.
NO_FLOOR = -BEYOND


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers: in doubles or 64-bit integers where these hold them,
    else in Python's integers."""
    top = max(1, int(np.abs(a).max(initial=0))) * max(1, int(np.abs(b).max(initial=0))) * a.shape[1]
    if top < 1 << 53:
        return (a @ b.T).astype(np.int64)
    if top < 1 << 63:
        return a.astype(np.int64) @ b.astype(np.int64).T
    a, b = (np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (a, b))
    return np.clip(a.dot(b.T), -BEYOND, BEYOND).astype(np.int64)


def survivors(q: np.ndarray, floor: float, unit: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Candidates (sorted by length, longest first) that may reach the score ``floor`` with ``q``."""
    size = float(np.sqrt((q.astype(float) ** 2).sum()))
    if floor <= 0 or size == 0 or not np.isfinite(size * length[0]):
        return np.arange(len(length))
    slack = 1e-9 * floor
    fits = int(np.searchsorted(-length, -(floor - slack) / size, side="right"))  # length pruning
    local = (floor - slack) / (size * length[0])
    if local < COORDINATES_FROM or not fits:
        return np.arange(fits)
    local = min(1.0, local)
    keep = np.ones(fits, bool)
    for f in np.argsort(-np.abs(q), kind="stable")[:FOCUS]:
        c = q[f] / size
        spread = np.sqrt(max(0.0, (1 - local * local) * (1 - c * c)))
        low = -1.0 if c < -local else c * local - spread
        high = 1.0 if c > local else c * local + spread
        x = unit[:fits, f]
        keep &= (x >= low - 1e-9) & (x <= high + 1e-9)
    return np.flatnonzero(keep)


def _best(score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((rows, ids, -score))[:k]


class _Queries:
    """Queries of one vector length with the best that a task has found for each."""

    def __init__(self, table: pa.Table, dim: int, scale: int, k: int):
        self.z, self.k = whole(table["vector"], dim, scale), k
        self.rows, self.ids, self.floor = (table[c].to_numpy() for c in ("row", "vec_id", "floor"))
        self.floor = self.floor.copy()
        self.size = np.sqrt((self.z ** 2).sum(axis=1))
        none = np.zeros(0, np.int64)
        self.found = [(none, none, none)] * len(self.rows)  # scores, ids, rows

    def search(self, z: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Take in the candidates of one bucket, longest first."""
        length = np.sqrt((z ** 2).sum(axis=1))
        with np.errstate(invalid="ignore"):
            unit = z / np.maximum(length, 1e-12)[:, None]
        reach = self.size * length[0] * (1 + 1e-9) >= self.floor
        reach |= ~np.isfinite(self.size * length[0]) | (self.floor <= 0)
        asked = np.flatnonzero(reach)
        for lo in range(0, len(asked), 256):
            part = asked[lo:lo + 256]
            stay = [survivors(self.z[i], float(self.floor[i]), unit, length) for i in part]
            every = products(self.z[part], z) if sum(map(len, stay)) > len(z) * len(stay) / 4 else None
            for n, (i, at) in enumerate(zip(part.tolist(), stay)):
                score = every[n, at] if every is not None else products(self.z[i:i + 1], z[at])[0]
                keep = (score >= self.floor[i]) & (rows[at] != self.rows[i])
                if keep.any():
                    self._take(i, score[keep], ids[at[keep]], rows[at[keep]])

    def _take(self, i: int, *new: np.ndarray) -> None:
        score, ids, rows = (np.concatenate(x) for x in zip(self.found[i], new))
        top = _best(score, ids, rows, self.k)
        self.found[i] = (score[top], ids[top], rows[top])
        if len(top) == self.k:
            self.floor[i] = max(self.floor[i], score[top[-1]])

    def results(self) -> pa.RecordBatch:
        score, ids, rows = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*self.found))
        if len(score) and np.abs(score).max() == BEYOND:
            raise OverflowError("a score is no 64-bit integer")
        n = [len(f[0]) for f in self.found]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in (np.repeat(self.rows, n), np.repeat(self.ids, n), rows, ids, score)],
                                          ["query_row", "query_id", "vec_row", "vec_id", "score"])


def _by_dim(table: pa.Table) -> Iterator[tuple[int, pa.Table]]:
    dims = table["dim"].to_numpy()
    for dim in np.unique(dims).tolist():
        yield dim, table.filter(pa.array(dims == dim))


def _searched(rows: DataFrame, block: pa.Table, k: int, scale: int, shard: int, numbers: int) -> DataFrame:
    """Each task's k best rows for every query of the block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = {dim: _Queries(t, dim, scale, k) for dim, t in _by_dim(block)}

        def search(held: list[pa.RecordBatch]) -> None:
            for dim, t in _by_dim(pa.Table.from_batches(held)):
                if dim not in asked:
                    continue
                order = np.argsort(-t["length"].to_numpy(), kind="stable")
                for lo in range(0, len(order), shard):
                    own = t.take(pa.array(order[lo:lo + shard]))
                    asked[dim].search(whole(own["vector"], dim, scale), own["vec_id"].to_numpy(), own["row"].to_numpy())

        held, size = [], 0
        for b in batches:
            if b.num_rows:
                held.append(b)
                size += len(b.column("vector").flatten())
            if size >= numbers:
                search(held)
                held, size = [], 0
        if held:
            search(held)
        for q in asked.values():
            yield q.results()

    return rows.select("vec_id", "vector", "length", "dim", "row").mapInArrow(
        run, "query_row long, query_id long, vec_row long, vec_id long, score long")


def _with_floors(asked: DataFrame, base: pa.Table, k: int, scale: int, shard: int) -> DataFrame:
    """The queries with ``floor``: the k-th best score among the longest vectors, where there are k."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longest = dict(_by_dim(base))
        for b in batches:
            t = pa.Table.from_batches([b])
            for dim, own in _by_dim(t):
                q = _Queries(own.append_column("floor", pa.array(np.full(len(own), NO_FLOOR))), dim, scale, k)
                near = longest.get(dim)
                for lo in range(0, len(near) if near else 0, shard):
                    part = near.slice(lo, shard)
                    q.search(whole(part["vector"], dim, scale), part["vec_id"].to_numpy(), part["row"].to_numpy())
                yield from own.append_column("floor", pa.array(q.floor)).combine_chunks().to_batches()

    kind = dict(asked.dtypes)["vector"]
    return asked.select("vec_id", "vector", "length", "dim", "row").mapInArrow(
        run, f"vec_id long, vector {kind}, length double, dim int, row long, floor long")


def top_k(vectors: DataFrame, every: int = 20, k: int = 20, scale: int = 64, shard: int = 4096,
          numbers: int = 1 << 21, block_mb: int = 64) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows for each row whose vec_id is
    divisible by ``every``, by the inner product of floor(scale * component).

    Ties go to the smaller vec_id. A row is never its own candidate, but a repeated
    row with the same vec_id is one. Null ids and vectors, empty ones and those with null
    or non-finite components take no part; vectors of different lengths are no candidates for
    each other. A vector of zeros takes part with score 0. Scores are exact at any size; a
    result that is no 64-bit integer raises OverflowError. An empty table gives an empty result.
    ``shard`` bounds a bucket's vectors, ``numbers`` the components a task holds and those of the longest vectors that
    floors are taken from, ``block_mb`` the queries that all tasks get at once; none changes results.
    """
    spark = vectors.sparkSession
    prepare(spark)

    def floored(x: Column) -> Column:
        y = F.lit(float(scale)) * x.cast("double")
        return F.when(F.abs(y) < float(1 << 53), F.floor(y).cast("double")).otherwise(y)  # larger ones are whole

    length = F.sqrt(F.aggregate(F.transform("vector", floored), F.lit(0.0), lambda s, x: s + x * x))
    rows = (vectors.select("vec_id", F.col("embedding").alias("vector"))
            .where(usable("vector") & F.col("vec_id").isNotNull())
            .select(F.col("vec_id").cast("long").alias("vec_id"), "vector", length.alias("length"),
                    F.size("vector").alias("dim"), F.monotonically_increasing_id().alias("source")))
    # Vectors of equal length spread by id and place, so no length, however frequent, is one task's.
    rows = rows.repartitionByRange(tasks(spark), F.desc("length"), F.col("vec_id"), F.col("source"))
    rows = stored(rows.drop("source").withColumn("row", F.monotonically_increasing_id()), "vectors")  # row numbers are fixed now
    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    size = asked.agg(F.sum(8 * F.col("dim") + 40).alias("bytes"), F.max("dim").alias("dim")).first()
    if not size["bytes"]:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    base = rows.orderBy(F.desc("length"), "row").limit(max(2 * k, numbers // size["dim"])).toArrow()
    asked = stored(_with_floors(asked, base, k, scale, shard), "queries")
    blocks = -(-size["bytes"] // (block_mb << 20))
    w = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "vec_row")
    out = scratch(spark, "top")
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).toArrow()  # about block_mb
        (_searched(rows, block, k, scale, shard, numbers).withColumn("rank", F.row_number().over(w))
         .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(out))
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(out)

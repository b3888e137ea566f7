"""Hard-negative mining with Kronecker-packed integer products.

Candidates' components are biased to be non-negative and several candidates are packed
into separated fields of one wide integer per component. Multiplying the wide integers
by an anchor's components, once each, and adding up leaves every candidate's product in
its own field; unpacked and freed of the bias it is exact. Wide integers of up to 53 bits
travel in doubles, where each step is exact and matrix products are fast; larger ones are
Python integers.

Anchors are a stated query set: they are taken in blocks of bounded size against all rows,
which stay where they are. Only the best of each task leave it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitlane.llm.common import prepare, scratch, stored
from pitlane.llm.forest import usable

#: Fields of a wide integer where doubles don't suffice.
WIDE = 32
_MOST = np.iinfo(np.int64).max


def whole(vectors: pa.ChunkedArray, dim: int, scale: int) -> np.ndarray:
    """floor(scale * x) of all components, as doubles that hold whole numbers."""
    flat = pa.concat_arrays([c.flatten() for c in vectors.chunks]) if vectors.num_chunks else pa.array([], pa.float64())
    with np.errstate(over="ignore"):
        z = np.floor(scale * flat.to_numpy(zero_copy_only=False).astype(np.float64))
    if np.isinf(z).any():
        raise OverflowError("a scaled component is too large for a double")
    return z.reshape(-1, dim)


def _as_int(z: np.ndarray) -> np.ndarray:
    """The same whole numbers as Python integers."""
    out = np.empty(z.shape, object)
    out.flat = [int(x) for x in z.flat]
    return out


class Packed:
    """Candidates (rows of whole numbers) packed for products with anchors.

    ``reach`` is the largest sum of an anchor's absolute components. Then a biased product is below
    reach * span in size; a field has a bit more than that and the sign need, so that none
    flows over into the next.
    """

    def __init__(self, z: np.ndarray, reach: int):
        self.n = len(z)
        low, high = int(z.min(initial=0)), int(z.max(initial=0))
        self.low = low
        self.width = (reach * (high - low)).bit_length() + 1
        self.fields = 53 // self.width
        self.doubles = self.fields >= 2 and reach * max(abs(low), abs(high)) < 1 << 62
        if not self.doubles:
            self.fields, z = WIDE, _as_int(z)
        padded = np.concatenate([z - low, np.zeros((-self.n % self.fields, z.shape[1]), z.dtype)])
        apart = np.array([1 << (self.width * f) for f in range(self.fields)], z.dtype)
        self.wide = (padded.reshape(-1, self.fields, z.shape[1]) * apart[:, None]).sum(axis=1)

    def products(self, anchors: np.ndarray) -> np.ndarray:
        """(anchors x candidates) exact inner products as 64-bit integers; those beyond are cut to the largest."""
        shift = [self.width * f for f in range(self.fields)]
        centre = 1 << (self.width - 1)
        mask = (1 << self.width) - 1
        lift = sum(centre << s for s in shift)  # makes every field non-negative
        if self.doubles:
            total = (anchors @ self.wide.T).astype(np.int64) + lift
            bias = self.low * anchors.sum(axis=1).astype(np.int64)
            out = np.empty((*total.shape, self.fields), np.int64)
        else:
            anchors = _as_int(anchors)
            total = anchors.dot(self.wide.T) + lift
            bias = self.low * anchors.sum(axis=1)
            out = np.empty((*total.shape, self.fields), object)
        for f, s in enumerate(shift):
            out[..., f] = ((total >> s) & mask) - centre
        score = out.reshape(len(anchors), -1)[:, :self.n] + bias[:, None]
        return score if self.doubles else np.clip(score, -_MOST, _MOST).astype(np.int64)


def best(score: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int) -> np.ndarray:
    """Where the k highest scores are, highest first, ties by smaller id and then row."""
    at = np.arange(len(score))
    if len(score) > 4 * k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return at[np.lexsort((rows[at], ids[at], -score[at]))[:k]]


def _checked(score: np.ndarray) -> np.ndarray:
    if len(score) and np.abs(score).max() == _MOST:
        raise OverflowError("a score is no 64-bit integer")
    return score


class _Anchors:
    """A block of anchors, by vector length and label."""

    def __init__(self, table: pa.Table, scale: int):
        dims = table["dim"].to_numpy()
        self.groups = {}
        for dim in np.unique(dims).tolist():
            own = table.filter(pa.array(dims == dim))
            z, labels = whole(own["vector"], dim, scale), own["label"].to_numpy()
            rows, ids = own["row"].to_numpy(), own["vec_id"].to_numpy()
            reach = max(int(sum(map(int, r))) for r in np.abs(z)) if np.abs(z).sum(axis=1).max() >= 1 << 52 \
                else int(np.abs(z).sum(axis=1).max())
            by_label = {lab: np.flatnonzero(labels == lab) for lab in np.unique(labels).tolist()}
            self.groups[dim] = (z, rows, ids, reach, by_label)


class _Shard:
    """Candidates of one vector length, in the order of label, id and row."""

    def __init__(self, table: pa.Table, dim: int, scale: int):
        order = np.lexsort((table["row"].to_numpy(), table["vec_id"].to_numpy(), table["label"].to_numpy()))
        table = table.take(pa.array(order))
        self.z = whole(table["vector"], dim, scale)
        self.rows, self.ids, self.labels = (table[c].to_numpy() for c in ("row", "vec_id", "label"))

    def of_label(self, label: int) -> slice:
        return slice(int(np.searchsorted(self.labels, label)), int(np.searchsorted(self.labels, label, side="right")))


def _shards(batches: Iterator[pa.RecordBatch], numbers: int, scale: int) -> Iterator[tuple[int, _Shard]]:
    """The partition's candidates in shards of about ``numbers`` components each."""
    held, size = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            size += len(b.column("vector").flatten())
        if size >= numbers:
            yield from _by_dim(held, scale)
            held, size = [], 0
    if held:
        yield from _by_dim(held, scale)


def _by_dim(held: list[pa.RecordBatch], scale: int) -> Iterator[tuple[int, _Shard]]:
    t = pa.Table.from_batches(held)
    dims = t["dim"].to_numpy()
    for dim in np.unique(dims).tolist():
        yield dim, _Shard(t.filter(pa.array(dims == dim)), dim, scale)


def _found(rows: list[tuple[np.ndarray, ...]], names: list[str]) -> pa.RecordBatch:
    columns = [np.concatenate([np.zeros(0, np.int64), *c]) for c in zip(*rows)] if rows else [np.zeros(0, np.int64)] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)


def _positives(candidates: DataFrame, asked: pa.Table, k: int, scale: int, numbers: int) -> DataFrame:
    """(anchor_row, row, vec_id, score): each task's k best other rows of every anchor's label."""
    names = ["anchor_row", "row", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = _Anchors(asked, scale)
        for dim, shard in _shards(batches, numbers, scale):
            z, rows, _, reach, by_label = anchors.groups.get(dim, (None, None, None, 0, {}))
            found = []
            for label, members in by_label.items():
                own = shard.of_label(label)
                if own.start == own.stop:
                    continue
                packed, ids, theirs = Packed(shard.z[own], reach), shard.ids[own], shard.rows[own]
                step = max(1, numbers // len(ids))
                for part in np.split(members, range(step, len(members), step)):
                    for a, score in zip(part, packed.products(z[part])):
                        other = np.flatnonzero(theirs != rows[a])
                        at = other[best(score[other], ids[other], theirs[other], k)]
                        found.append((np.full(len(at), rows[a]), theirs[at], ids[at], _checked(score[at])))
            yield _found(found, names)

    return candidates.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _negatives(candidates: DataFrame, asked: pa.Table, positives: pa.Table, k: int, lower: int, upper: int,
               scale: int, numbers: int) -> DataFrame:
    """Each task's k best rows of another label for every anchor and positive, by scores in the band."""
    names = ["anchor_row", "anchor_id", "positive_row", "positive_id", "positive_score", "row", "vec_id", "score"]
    pairs = positives.sort_by("anchor_row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = _Anchors(asked, scale)
        of, prow, pid, pscore = (pairs[c].to_numpy() for c in ("anchor_row", "row", "vec_id", "score"))
        for dim, shard in _shards(batches, numbers, scale):
            z, rows, ids_of, reach, by_label = anchors.groups.get(dim, (None, None, None, 0, {}))
            found = []
            packed = Packed(shard.z, reach)
            step = max(1, numbers // len(shard.ids))
            for label, members in by_label.items():
                same = shard.of_label(label)
                for part in np.split(members, range(step, len(members), step)):
                    for a, score in zip(part, packed.products(z[part])):
                        own = range(*np.searchsorted(of, [rows[a], rows[a] + 1]))
                        # lower * positive <= 100 * score <= upper * positive; a negative positive leaves none
                        bands = [(p, -(-lower * int(pscore[p]) // 100), upper * int(pscore[p]) // 100) for p in own]
                        if not bands:
                            continue
                        near = (score >= min(b[1] for b in bands)) & (score <= max(b[2] for b in bands))
                        near[same] = False
                        near = np.flatnonzero(near)
                        some, ids, theirs = score[near], shard.ids[near], shard.rows[near]
                        for p, low, high in bands:
                            at = np.flatnonzero((some >= low) & (some <= high))
                            at = at[best(some[at], ids[at], theirs[at], k)]
                            n = len(at)
                            found.append((np.full(n, rows[a]), np.full(n, ids_of[a]), np.full(n, prow[p]), np.full(n, pid[p]),
                                          np.full(n, pscore[p]), theirs[at], ids[at], some[at]))
            yield _found(found, names)

    return candidates.mapInArrow(run, ", ".join(f"{n} long" for n in names))


def _first(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("score"), "vec_id", "row")
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def mined(vectors: DataFrame, every: int = 100, positives: int = 5, negatives: int = 10, lower: int = 30,
          upper: int = 90, scale: int = 256, numbers: int = 1 << 21, block_mb: int = 64) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for rows (vec_id, embedding, label).

    Anchors are rows whose vec_id is divisible by ``every``. A score is the inner product of
    floor(scale * component), components as doubles; higher scores come first, ties by smaller vec_id. An
    anchor's positives are its first ``positives`` other rows of its label; for each, the first
    ``negatives`` rows of another label with lower * positive_score <= 100 * score <= upper * positive_score.

    Rows with a null id, label or vector, an empty vector, or a null or non-finite component take no part.
    Vectors of different lengths are no partners. Repeated rows are rows of their own: copies of an anchor are
    anchors, and its positives. Fewer partners give fewer rows, an empty table an empty result. Scores are exact
    at any size; a returned score beyond 64 bits raises OverflowError. Other columns are not read.
    ``block_mb`` bounds the anchors that all tasks get at once, ``numbers`` the components and
    products a task holds; neither changes results.
    """
    spark = vectors.sparkSession
    prepare(spark)
    rows = (vectors.select("vec_id", "label", F.col("embedding").alias("vector"))
            .where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("vector"))
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "vector")
            .withColumn("dim", F.size("vector")).withColumn("row", F.monotonically_increasing_id()))
    rows = stored(rows, "vectors")  # from here on the row numbers are fixed
    asked = rows.where(F.pmod("vec_id", F.lit(every)) == 0)
    size = asked.agg(F.sum(8 * F.col("dim") + 32).alias("bytes")).first()["bytes"]
    names = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not size:
        return spark.createDataFrame([], names)
    blocks = -(-size // (block_mb << 20))
    out = scratch(spark, "negatives")
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).toArrow()  # about block_mb
        if not block.num_rows:
            continue
        found = _first(_positives(rows, block, positives, scale, numbers), ["anchor_row"], positives).drop("rank")
        pairs = found.toArrow()  # at most ``positives`` rows per anchor of the block
        found = _negatives(rows, block, pairs, negatives, lower, upper, scale, numbers)
        (_first(found, ["anchor_row", "positive_row"], negatives)
         .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
                 F.col("score").alias("negative_score")).write.mode("append").parquet(out))
    return spark.read.schema(names).parquet(out)

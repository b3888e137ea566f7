"""Embedding near-duplicates through a forest of random-projection trees.

Vectors that are equal make one class. Each tree splits the classes by random
directions at the median, with a band of spill around it that goes to both sides;
the band follows from how far apart two vectors over the threshold lie along a random
direction. Classes are compared inside leaves only and links are verified in double
precision. A class carries its leaves in all trees, so a pair is counted in the first leaf
that it shares and no list of pairs is needed: leaves return numbers of links, and links
enough to span what they link, and these are united.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import prepare, stored, tasks
from pitlane.llm.components import connected_components


def usable(vector: str) -> Column:
    """The vector is not null or empty, has no null or non-finite component."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(v.isNotNull() & (F.size(v) > 0) & ~bad, F.lit(False))


def grow(sample: np.ndarray, trees: int, leaf: int, band: float, seed: int = 11) -> list[list[tuple]]:
    """Trees over unit vectors: nodes (direction, median, left, right) and leaves (None, number, 0, 0)."""
    rng = np.random.default_rng(seed)
    forest = []
    for _ in range(trees):
        nodes: list[tuple] = []
        leaves = 0

        def split(members: np.ndarray) -> int:
            nonlocal leaves
            at = len(nodes)
            nodes.append(())
            if len(members) > leaf:
                for _ in range(3):
                    direction = rng.normal(size=sample.shape[1])
                    direction /= np.linalg.norm(direction)
                    along = sample[members] @ direction
                    middle = float(np.median(along))
                    left, right = members[along <= middle + band], members[along > middle - band]
                    if max(len(left), len(right)) < 0.8 * len(members):
                        nodes[at] = (direction, middle, split(left), split(right))
                        return at
            nodes[at] = (None, leaves, 0, 0)
            leaves += 1
            return at

        split(np.arange(len(sample)))
        forest.append(nodes)
    return forest


def leaves_of(nodes: list[tuple], x: np.ndarray, band: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) for all leaves that each unit vector of ``x`` falls or spills into."""
    rows, leaf = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    todo = [(0, np.arange(len(x)))]
    while todo:
        at, idx = todo.pop()
        direction, middle, left, right = nodes[at]
        if not len(idx):
            continue
        if direction is None:
            rows.append(idx)
            leaf.append(np.full(len(idx), middle, np.int64))
            continue
        along = x[idx] @ direction
        todo += [(left, idx[along <= middle + band]), (right, idx[along > middle - band])]
    return np.concatenate(rows), np.concatenate(leaf)


def _matrix(column: pa.ChunkedArray, dim: int) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], pa.float32())
    x = flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def links_of(classes: DataFrame, threshold: float, trees: int, leaf: int, block: int,
             sample: int) -> DataFrame:
    """(u, v, others) for classes (cid, label, dim, vector, copies) with equal labels.

    Rows without v: ``others`` rows of other classes link with class u (to be summed). Rows with v: verified
    links, u < v, enough of them to span every group of linked classes. Both are in proportion to the
    classes, however many pairs link.
    """
    dims = [r["dim"] for r in classes.select("dim").distinct().orderBy("dim").collect()]
    links = classes.sparkSession.createDataFrame([], "u long, v long, others long")
    for dim in dims:  # vectors of different lengths have no cosine; a table has one or few lengths
        own = classes.where(F.col("dim") == dim)
        links = links.unionByName(_links(own, dim, threshold, trees, leaf, block, sample))
    return links


def apart_so_far(codes: list[np.ndarray], code: int) -> tuple[np.ndarray, np.ndarray]:
    """(kind of each class, matrix of kinds): whether two kinds of classes meet in a leaf before ``code``."""
    before = [tuple(c[c < code].tolist()) for c in codes]
    kinds = {k: i for i, k in enumerate(dict.fromkeys(before))}
    met = np.zeros((len(kinds), len(kinds)), bool)
    members: dict[int, list[int]] = {}
    for k, i in kinds.items():
        for c in k:
            members.setdefault(c, []).append(i)
    for own in members.values():
        met[np.ix_(own, own)] = True
    return np.array([kinds[k] for k in before]), met


def spanning(linked: np.ndarray, left: np.ndarray, right: np.ndarray, group: np.ndarray) -> list[tuple[int, int]]:
    """Links (left, right) that join what is not in one ``group`` yet; ``group`` is brought up to date."""
    out = []
    for r in np.flatnonzero(linked.any(axis=1)):
        near = right[linked[r]]
        own = group[left[r]]
        other, first = np.unique(group[near], return_index=True)
        for g, at in zip(other.tolist(), first.tolist()):
            if g != own:
                out.append((left[r], near[at]))
                group[group == g] = own
    return out


def _links(classes: DataFrame, dim: int, threshold: float, trees: int, leaf: int, block: int,
           sample: int) -> DataFrame:
    spark = classes.sparkSession
    band = 0.8 * (2 * (1 - threshold) / dim) ** 0.5
    total = classes.count()
    drawn = (classes.orderBy(F.xxhash64("vector"), "vector").limit(sample).select("vector")).toArrow()
    members = _matrix(drawn["vector"], dim)
    forest = grow(members, trees, max(16, leaf * len(members) // max(1, total)), band)

    def deal(batches):
        for b in batches:
            x = _matrix(pa.chunked_array([b.column("vector")]), dim)
            parts = [leaves_of(nodes, x, band) for nodes in forest]
            row = np.concatenate([r for r, _ in parts])
            code = np.concatenate([(t << 40) + at for t, (_, at) in enumerate(parts)])
            order = np.lexsort((code, row))
            ends = np.searchsorted(row[order], np.arange(len(x) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(code[order]))],
                                             ["cid", "label", "copies", "vector", "codes"])

    kind = dict(classes.dtypes)["vector"]
    dealt = stored(classes.select("cid", F.col("label").cast("string").alias("label"), "copies", "vector").mapInArrow(
        deal, f"cid long, label string, copies long, vector {kind}, codes array<long>"), "leaves")
    # An over-full leaf (of one label) is compared in pairs of blocks, each in a task of its own.
    sizes = dealt.select("label", F.explode("codes").alias("code")).groupBy("code", "label").agg(F.count("*").alias("n"))
    full = sizes.where(F.col("n") > 1).select("code", "label", F.ceil(F.col("n") / block).alias("blocks"))
    cut = (dealt.withColumn("code", F.explode("codes")).join(full, ["code", "label"])  # alone in a leaf: nothing to compare
           .withColumn("b", F.pmod(F.xxhash64("cid"), F.col("blocks")))
           .withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("code", "label", F.least("b", "k").alias("i"), F.greatest("b", "k").alias("j"),
                   "b", "cid", "copies", "codes", "vector"))

    def near(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids, x, copies = table["cid"].to_numpy(), _matrix(table["vector"], dim), table["copies"].to_numpy().astype(float)
        code, _, i, j = (k.as_py() for k in key)
        b = table["b"].to_numpy()
        one, two = np.flatnonzero(b == i), np.flatnonzero(b == j)
        lists = table["codes"].combine_chunks()
        flat, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        # A pair counts in the first leaf that both are in, so in one group of all.
        of, met = apart_so_far([flat[lo:hi] for lo, hi in zip(ends[:-1], ends[1:])], code)
        others, group, links = np.zeros(len(ids)), np.arange(len(ids)), []
        step = max(1, 4_000_000 // max(1, len(two)))
        for lo in range(0, len(one), step):
            part = one[lo:lo + step]
            linked = x[part] @ x[two].T >= threshold
            linked &= ~met[np.ix_(of[part], of[two])]
            if i == j:
                linked[np.arange(len(part)), np.arange(lo, lo + len(part))] = False
            else:
                others[two] += copies[part] @ linked
            others[part] += linked @ copies[two]
            links += spanning(linked, part, two, group)
        some = np.flatnonzero(others)
        u, v = (np.array([ids[x[n]] for x in links], np.int64) for n in (0, 1))
        return pa.table({
            "u": np.concatenate([ids[some], np.minimum(u, v)]),
            "v": pa.array(np.concatenate([np.zeros(len(some), np.int64), np.maximum(u, v)]),
                          mask=np.arange(len(some) + len(u)) < len(some)),
            "others": np.concatenate([others[some].astype(np.int64), np.zeros(len(u), np.int64)])})

    keys = ["code", "label", "i", "j"]
    return cut.repartition(tasks(spark), *keys).groupBy(*keys).applyInArrow(near, "u long, v long, others long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.98, trees: int = 4, leaf: int = 4096,
                    block: int = 4096, sample: int = 20_000) -> DataFrame:
    """Rows of (vec_id, embedding, label) as (vec_id, n_links, component_id, kept).

    Vectors link if their labels are equal and their cosine is at least
    ``threshold``; pairs are searched in the forest's leaves (recall is tested
    against brute force), none below the threshold ever links. Null labels, null or
    zero vectors and such with null or non-finite components link with nothing and
    are their own component. Equal vectors of a label always link. n_links counts
    rows, so repeated rows count; a null vec_id is never a component's name unless all
    its ids are null. ``sample`` bounds the vectors the trees are grown from; every
    vector is then dealt through them. An empty table gives an empty result.
    """
    prepare(vectors.sparkSession)
    rows = vectors.select("vec_id", "label", F.col("embedding").alias("vector"))
    zero = F.forall("vector", lambda x: x == 0)
    rows = rows.withColumn("ok", usable("vector") & F.col("label").isNotNull() & F.coalesce(~zero, F.lit(False)))
    key = ["label", "vector"]
    classes = (rows.where("ok").groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"))
               .withColumn("cid", F.monotonically_increasing_id()).withColumn("dim", F.size("vector")))
    classes = stored(classes, "classes")  # from here on the class numbers are fixed
    found = stored(links_of(classes, threshold, trees, leaf, block, sample), "links")
    links = found.where("v IS NOT NULL").select("u", "v")
    degree = found.where("v IS NULL").groupBy(F.col("u").alias("cid")).agg(F.sum("others").alias("others"))
    comp = connected_components(links).withColumnRenamed("node", "cid")
    of = (classes.join(degree, "cid", "left").join(comp, "cid", "left")
          .withColumn("component", F.coalesce("component", "cid")))
    low = of.groupBy("component").agg(F.min("rep").alias("component_id"))
    of = (of.join(low, "component")
          .select(*key, (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"))
    linked = rows.where("ok").join(of, key).select("vec_id", "n_links", "component_id")
    alone = rows.where("not ok").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                        F.col("vec_id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"),
                                             F.col("vec_id").isNull() & F.col("component_id").isNull()))

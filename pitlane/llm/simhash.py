"""SimHash fingerprints and near-duplicate groups through a vantage-point tree.

Fingerprints are taken from whole texts. Equal fingerprints form one class; the
classes are dealt to the leaves of a vantage-point tree over Hamming distance. A
node sends a fingerprint inside when its distance to the vantage point is at most
the node's radius plus ``max_bits`` and outside when it is over the radius: by the
triangle inequality two fingerprints within ``max_bits`` bits always meet in a
leaf, and those near a boundary are searched on both sides. A leaf is one shard of
the job; inside it a tree of its own members prunes in the same way before exact
pair tests. An over-full shard is split again by a tree of its own, by many tasks; one
that no tree parts is dealt in blocks, so no task holds more than two.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane.llm.common import held, prepare, quoted, stored, tasks
from pitlane.llm.components import connected_components

SEED = 42
_CHUNK = 1 << 16


def fingerprint(text: bytes | None, words: int = 3) -> int:
    """64-bit SimHash of a text's word shingles; 0 for null and texts without words.

    A-Z are lower-cased, words are split at ASCII white space, repeats count. A bit
    is 1 if it is set in over half of the shingle hashes.
    """
    if not text:
        return 0
    w = text.lower().split()
    if not w:
        return 0
    if len(w) <= words:
        return xxhash.xxh64_intdigest(b" ".join(w), SEED)
    digest, n = xxhash.xxh64_intdigest, len(w) - words + 1
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        part = w[at:min(n, at + _CHUNK) + words - 1]
        h = np.array([digest(b" ".join(s), SEED) for s in zip(*(part[i:] for i in range(words)))],
                     dtype="<u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1,
                                bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``docs`` with a long column ``fp`` (the fingerprint's 64 bits, as signed)."""
    prepare(docs.sparkSession)

    @F.arrow_udf("bigint")
    def fp(texts: pa.Array) -> pa.Array:
        held(("simhash",), dict)
        out = np.fromiter((fingerprint(t, words) for t in texts.to_pylist()), np.uint64, len(texts))
        return pa.array(out.view(np.int64))

    return docs.withColumn("fp", fp(F.col("text").cast("binary")))


def distances(x: np.ndarray, to: int) -> np.ndarray:
    return np.bitwise_count(x ^ np.uint64(to))


def build_tree(sample: np.ndarray, leaf: int, max_bits: int, seed: int = 7) -> list[tuple]:
    """Nodes (vantage, radius, inner, outer); a leaf is (None, leaf number, 0, 0)."""
    rng = np.random.default_rng(seed)
    nodes: list[tuple] = []
    leaves = 0

    def grow(members: np.ndarray) -> int:
        nonlocal leaves
        at = len(nodes)
        nodes.append(())
        best = None
        if len(members) > leaf:
            for v in rng.choice(members, 8):
                d = distances(members, v)
                radius = int(np.median(d))
                inner, outer = members[d <= radius + max_bits], members[d > radius]
                if len(outer) and len(inner) < len(members) and \
                        (best is None or len(inner) + len(outer) < best[0]):
                    best = (len(inner) + len(outer), int(v), radius, inner, outer)
        if best is None or best[0] > 1.7 * len(members):
            nodes[at] = (None, leaves, 0, 0)
            leaves += 1
        else:
            _, v, radius, inner, outer = best
            nodes[at] = (v, radius, grow(inner), grow(outer))
        return at

    grow(sample)
    return nodes


def leaves_of(nodes: list[tuple], x: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of every leaf in which each fingerprint of ``x`` must be tested."""
    rows, leaf = [], []
    todo = [(0, np.arange(len(x)))]
    while todo:
        at, idx = todo.pop()
        if not len(idx):
            continue
        v, radius, inner, outer = nodes[at]
        if v is None:
            rows.append(idx)
            leaf.append(np.full(len(idx), radius, np.int64))
            continue
        d = distances(x[idx], v)
        todo += [(inner, idx[d <= radius + max_bits]), (outer, idx[d > radius])]
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(leaf)


def local_links(x: np.ndarray, other: np.ndarray | None, max_bits: int) -> list[tuple[int, int]]:
    """Links (member, smallest-index member) that join all pairs within ``max_bits``
    of ``x`` (with ``other``: pairs of one of ``x`` and one of ``other``)."""
    every = x if other is None else np.concatenate([x, other])
    first = 0 if other is None else len(x)
    comp = np.arange(len(every))
    step = max(1, 2_000_000 // max(1, len(every)))
    for lo in range(0, len(x), step):
        a = x[lo:lo + step]
        start = lo if other is None else first
        near = np.bitwise_count(a[:, None] ^ every[None, start:]) <= max_bits
        for i in np.flatnonzero(near.sum(axis=1) > (other is None)):
            ids = np.unique(comp[np.append(start + np.flatnonzero(near[i]), lo + i)])
            if len(ids) > 1:
                comp[np.isin(comp, ids[1:])] = ids[0]
    child = np.flatnonzero(comp != np.arange(len(every)))
    return list(zip(every[child].tolist(), every[comp[child]].tolist()))


def links_within(x: np.ndarray, max_bits: int, leaf: int = 512) -> list[tuple[int, int]]:
    """``local_links`` of the distinct ``x``, through a tree grown from all of them."""
    nodes = build_tree(x, leaf, max_bits)
    if len(nodes) == 1:
        return local_links(x, None, max_bits)
    row, at = leaves_of(nodes, x, max_bits)
    order = np.argsort(at, kind="stable")
    cuts = np.flatnonzero(np.diff(at[order])) + 1
    return list({link for part in np.split(row[order], cuts)
                 for link in local_links(x[part], None, max_bits)})


def _child(leaf: np.ndarray | int, number: np.ndarray) -> np.ndarray:
    """A name for a leaf inside a leaf. If two ever shared one they would only be compared together."""
    mixed = (np.uint64(leaf) + np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (mixed ^ (number.astype(np.uint64) + np.uint64(1))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))).view(np.int64)


def _split_again(dealt: DataFrame, over: DataFrame, max_bits: int, shard: int, block: int, sample: int) -> DataFrame:
    """The rows (leaf, fp) of the over-full leaves ``over`` (leaf, n), dealt through a tree of each leaf's own.

    A tree is grown from about ``sample`` of the leaf's fingerprints, chosen by hash; the leaf is dealt by many tasks. Rows of
    a leaf that no tree parts keep it and are marked ``closed``.
    """
    rows = dealt.join(over, "leaf")

    def grown(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        x = np.unique(table["fp"].to_numpy()).view(np.uint64)
        nodes = build_tree(x, max(16, shard * len(x) // table["n"][0].as_py()), max_bits)
        return pa.table({"leaf": pa.array([key[0].as_py()]), "tree": pa.array([pickle.dumps(nodes)], pa.binary())})

    drawn = rows.where(F.pmod(F.xxhash64("fp", F.lit(1)), F.col("n")) < sample)
    trees = drawn.groupBy("leaf").applyInArrow(grown, "leaf long, tree binary")
    salts = F.ceil(F.col("n") / block).cast("int")
    trees = trees.join(over, "leaf").withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("fp"), salts).cast("int"))

    def deal(members: pa.Table, tree: pa.Table) -> pa.Table:
        fp = members["fp"].to_numpy()
        leaf = members["leaf"].to_numpy()
        nodes = pickle.loads(tree["tree"][0].as_py()) if len(tree) else [(None, 0, 0, 0)]
        if not len(fp) or len(nodes) == 1:
            return pa.table({"leaf": leaf, "fp": fp, "closed": np.ones(len(fp), bool)})
        row, number = leaves_of(nodes, fp.view(np.uint64), max_bits)
        return pa.table({"leaf": _child(int(leaf[0]) & (1 << 64) - 1, number), "fp": fp[row], "closed": np.zeros(len(row), bool)})

    keys = ["leaf", "salt"]
    return (rows.select("leaf", "salt", "fp").groupBy(*keys)
            .cogroup(trees.select("leaf", "salt", "tree").groupBy(*keys))
            .applyInArrow(deal, "leaf long, fp long, closed boolean"))


def shards_of(classes: DataFrame, max_bits: int, shard: int, block: int, sample: int, rounds: int = 8) -> DataFrame:
    """(leaf, fp): every fingerprint in each leaf in which it must be tested; leaves of about ``shard``.

    Over-full leaves are split again, each by a tree of its own, until no tree parts them: the first tree's sample
    need not show how all fingerprints lie.
    """
    total = classes.count()
    drawn = classes.orderBy(F.xxhash64("fp"), "fp").limit(sample).collect()
    members = np.array([r["fp"] for r in drawn], np.int64).view(np.uint64)
    nodes = build_tree(members, max(64, int(shard * len(members) / max(1, total))), max_bits)

    def deal(batches):
        for b in batches:
            x = b.column(0).to_numpy(zero_copy_only=False)
            rows, leaf_ids = leaves_of(nodes, x.view(np.uint64), max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(leaf_ids), pa.array(x[rows]), pa.array(np.zeros(len(rows), bool))],
                                             ["leaf", "fp", "closed"])

    open_ = stored(classes.select("fp").mapInArrow(deal, "leaf long, fp long, closed boolean"), "leaves")
    done = []
    for _ in range(rounds):
        over = open_.where("not closed").groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") > 2 * shard)
        over = stored(over, "over-full")
        if over.isEmpty():
            break
        done.append(open_.join(over, "leaf", "left_anti"))
        open_ = stored(_split_again(open_.select("leaf", "fp"), over, max_bits, shard, block, sample), "leaves")
    out = open_
    for d in done:
        out = out.unionByName(d)
    return out.select("leaf", "fp")


def near_links(classes: DataFrame, max_bits: int = 3, shard: int = 32768, block: int = 65536,
               sample: int = 20_000) -> DataFrame:
    """Links (u, v) that connect distinct fingerprints ``fp`` as all pairs within
    ``max_bits`` bits would.

    ``sample`` bounds the fingerprints that a tree is grown from (in the order of a
    hash, so always the same); every fingerprint is then dealt through the trees. Only a leaf of over
    ``block`` fingerprints that no tree parts is compared in pairs of blocks.
    """
    spark = classes.sparkSession
    dealt = shards_of(classes, max_bits, shard, block, sample)
    full = (dealt.groupBy("leaf").agg(F.count("*").alias("n")).where(F.col("n") > block)
            .select("leaf", F.ceil(F.col("n") / block).alias("blocks")))
    dealt = (dealt.join(full, "leaf", "left").fillna(1, ["blocks"])
             .withColumn("b", F.pmod(F.xxhash64("fp"), F.col("blocks")))
             .withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("leaf", F.least("b", "k").alias("i"), F.greatest("b", "k").alias("j"), "b", "fp"))

    def links(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        x = table["fp"].to_numpy().view(np.uint64)
        _, i, j = (k.as_py() for k in key)
        if i == j:
            found = links_within(np.unique(x), max_bits)
        else:
            b = table["b"].to_numpy()
            found = local_links(x[b == i], x[b == j], max_bits)
        u = np.array([p[0] for p in found], np.uint64).view(np.int64)
        v = np.array([p[1] for p in found], np.uint64).view(np.int64)
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return (dealt.repartition(tasks(spark), "leaf", "i", "j").groupBy("leaf", "i", "j")
            .applyInArrow(links, "u long, v long"))


def near_duplicates(docs: DataFrame, words: int = 3, max_bits: int = 3, keep: bool = False) -> DataFrame:
    """All rows of ``docs`` (whatever their columns) as (doc_id, fp, component_id).

    component_id is the smallest doc_id reachable through links of at most
    ``max_bits`` differing bits. Null and empty texts have fingerprint 0. Rows with
    a null doc_id take part and get their group's smallest id (null if it has
    none); repeated rows stay repeated. An empty table gives an empty result. With
    ``keep`` the result is written to the shared folder, for callers that read it often.
    """
    out = _grouped(docs, words, max_bits).select("doc_id", "fp", "component_id")
    return stored(out, "groups") if keep else out


def _grouped(docs: DataFrame, words: int, max_bits: int) -> DataFrame:
    """(doc_id, fp, component, component_id): components with a common smallest doc_id stay apart."""
    prepare(docs.sparkSession)
    marked = stored(fingerprints(docs.select("doc_id", "text"), words).select("doc_id", "fp"),
                    "fingerprints")
    classes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")), "classes")
    comp = connected_components(near_links(classes, max_bits))
    groups = (classes.join(comp.withColumnRenamed("node", "fp"), "fp", "left")
              .withColumn("component", F.coalesce("component", "fp")))
    low = groups.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = groups.join(low, "component").select("fp", "component", "component_id")
    return marked.join(of_class, "fp").select("doc_id", "fp", "component", "component_id")


def _sortable(kind: T.DataType) -> bool:
    """Whether values of this type have an order."""
    if isinstance(kind, T.ArrayType):
        return _sortable(kind.elementType)
    if isinstance(kind, T.StructType):
        return all(_sortable(f.dataType) for f in kind.fields)
    return not isinstance(kind, T.MapType | T.VariantType)


def deduplicated(docs: DataFrame, words: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: its smallest doc_id's.

    Of several rows of the group with that id, or of a group in which every id is
    null, one stays (the first by fingerprint, text and the other columns, nulls first; columns
    without an order, such as maps, count by their JSON). Columns may have any name and type.
    """
    marked = stored(_grouped(docs, words, max_bits), "groups")
    kept = marked.where("doc_id = component_id").select(F.col("doc_id").alias("kept")).distinct()
    # The ids grow with the documents, so they are never broadcast; hashing spares sorting whole texts.
    kept = kept.hint("shuffle_hash")
    # The caller's columns travel in a struct, so no inner name meets one of theirs.
    whole = docs.select(F.struct(*[quoted(c).alias(c) for c in docs.columns]).alias("row"), "doc_id", "text")
    rows = whole.join(kept, F.col("doc_id") == F.col("kept"), "left_semi")
    row = F.col("row")
    others = [row.getField(f.name) if _sortable(f.dataType) else F.to_json(F.struct(row.getField(f.name).alias("v")))
              for f in docs.schema if f.name not in ("doc_id", "text")]

    def first_of_each(some: DataFrame, places: DataFrame) -> DataFrame:
        """One row of ``some`` for each component of ``places`` (doc_id, fp, component)."""
        places = places.select(F.col("doc_id").alias("id"), F.col("fp").alias("print"), "component").distinct()
        fits = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("fp") == F.col("print"))
        order = F.struct(*[c.alias(f"o{i}") for i, c in enumerate((F.col("fp"), F.col("text"), *others, F.col("doc_id")))])
        best = fingerprints(some, words).join(places, fits).groupBy("component").agg(F.min_by("row", order).alias("row"))
        return best.select("row")

    twice = (marked.groupBy("doc_id").agg(F.count("*").alias("n"))
             .where("n > 1 and doc_id is not null").select("doc_id"))
    if twice.isEmpty():  # repeated ids are rare: without any, whole texts are moved once only
        rows = rows.select("row")
    else:
        places = marked.where("doc_id = component_id").join(twice, "doc_id", "left_semi")
        several = first_of_each(rows.join(twice, "doc_id", "left_semi"), places)
        rows = rows.join(twice, "doc_id", "left_anti").select("row").unionByName(several)
    nameless = marked.where("doc_id is null and component_id is null")
    if not nameless.isEmpty():
        rows = rows.unionByName(first_of_each(whole.where("doc_id is null"), nameless))
    return rows.select("row.*")

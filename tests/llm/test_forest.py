import numpy as np

from pitlane.llm import forest, registry

SCHEMA = "vec_id long, embedding array<float>, label int, cid string, component string, leaf int"


def brute(rows, threshold=0.98):
    ok = [n for n, (i, v, label) in enumerate(rows) if label is not None and v
          and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {n: np.array(rows[n][1], np.float32).astype(float) for n in ok}
    unit = {n: v / np.linalg.norm(v) for n, v in unit.items()}
    links = [(a, b) for k, a in enumerate(ok) for b in ok[k + 1:]
             if rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a
    degree = [0] * len(rows)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
        root[find(a)] = find(b)
    low = {}
    for n in range(len(rows)):
        i = rows[n][0]
        r = find(n)
        low[r] = min((x for x in (low.get(r), i) if x is not None), default=None)
    key = lambda t: tuple(-1 if x is None else x for x in t)
    return sorted(((rows[n][0], degree[n], low[find(n)]) for n in range(len(rows))), key=key)


def run(spark, rows, **settings):
    df = spark.createDataFrame([(*r, "c", "d", 1) for r in rows], SCHEMA)
    out = forest.near_duplicates(df, **settings).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    key = lambda t: tuple(-1 if x is None else x for x in t)
    return sorted(((r.vec_id, r.n_links, r.component_id) for r in out), key=key)


def clusters(n, dim=16, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 6, dim))
    x = centres[rng.integers(len(centres), size=n)] + rng.normal(size=(n, dim)) * 0.08
    return [(i, [float(v) for v in np.float32(row)], int(rng.integers(3))) for i, row in enumerate(x)]


def test_same_links_as_brute_force(spark):
    rows = clusters(600)
    want = brute(rows)
    assert sum(d for _, d, _ in want) > 200
    assert run(spark, rows) == want
    got = run(spark, rows, trees=6, leaf=32, block=20)
    assert sum(d for _, d, _ in got) >= 0.9 * sum(d for _, d, _ in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want))


def test_odd_vectors(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 0), (2, v, 0), (2, v, 0), (3, v, 1), (4, v, None), (5, None, 0), (6, [], 0), (7, [0.0] * 3, 0),
            (8, [1.0, None, 3.0], 0), (9, [float("nan")] * 3, 0), (10, [2.0, 4.0, 6.0], 0), (11, [1.0, 2.0], 0),
            (None, v, 0), (None, [0.0] * 3, 0), (12, [-1.0, -2.0, -3.0], 0), (13, [float("inf"), 1.0, 1.0], 0),
            (14, [0.0, 1.0, 0.0], 2), (15, [-0.0, 1.0, 0.0], 2)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_recall_on_given_table(spark):
    sf = "/root/testdata/check_s"
    from pathlib import Path
    sf = sf if Path(sf).exists() else "/root/testdata/sf0.1"
    e = spark.read.parquet(f"{sf}/embeddings.parquet").limit(4000).toPandas()
    x = np.stack(e.embedding.to_numpy()).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.98) & (e.label.to_numpy()[:, None] == e.label.to_numpy())
    want = near.sum(axis=1) - 1
    out = forest.near_duplicates(spark.createDataFrame(e), trees=4, leaf=64).toPandas().set_index("vec_id").n_links
    got = out.loc[e.vec_id].to_numpy()
    assert (got <= want).all() and got.sum() >= 0.9 * want.sum()


def test_query_rows(spark):
    out = registry.op5_forest(spark, "/root/testdata/sf0.001")
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert out.count() == spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").count()


def test_output_of_leaves_is_linear(spark):
    """400 near copies have 79,800 links; what leaves the leaves is in proportion to the vectors."""
    from pyspark.sql import functions as F
    rng = np.random.default_rng(3)
    x = np.float32(np.r_[np.ones((400, 8)) + rng.normal(size=(400, 8)) * 0.01, rng.normal(size=(400, 8))])
    rows = [(i, [float(c) for c in v], 1) for i, v in enumerate(x)]
    assert run(spark, rows, leaf=64, block=50) == brute(rows)
    classes = spark.createDataFrame([(i, 1, 8, v, 1) for i, v, _ in rows], "cid long, label int, dim int, vector array<float>, copies long")
    for block in (50, 4096):
        out = forest.links_of(classes, 0.98, 4, 64, block, 1000)
        assert out.where("v IS NOT NULL").count() < 4 * 800 * max(1, 400 // block) and out.where("v IS NULL").count() < 16 * 800
    counts = out.where("v IS NULL").groupBy("u").agg(F.sum("others").alias("n")).where("u < 400")
    assert counts.agg(F.min("n"), F.max("n"), F.count("*")).first() == (399, 399, 400)


def test_spanning_links_join_the_same_groups():
    rng = np.random.default_rng(4)
    for _ in range(50):
        n = 30
        a = np.triu(rng.random((n, n)) < rng.choice([0.02, 0.1, 0.5]), 1)
        a |= a.T
        group = np.arange(n)
        links = forest.spanning(a, np.arange(n), np.arange(n), group)
        root = np.arange(n)
        for u, v in zip(*np.nonzero(a)):
            root[root == root[u]] = root[v]
        same = lambda r: r[:, None] == r
        assert (same(group) == same(root)).all() and len(links) == n - len(set(root.tolist()))


def test_recall_at_the_registered_settings(spark):
    """Whole check table (10,256 vectors) with the settings that the query uses."""
    from pathlib import Path
    sf = "/root/testdata/check_s" if Path("/root/testdata/check_s").exists() else "/root/testdata/sf0.1"
    e = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    got = registry.op5_forest(spark, sf).toPandas().set_index("vec_id").n_links
    found = want = 0
    for _, own in e.groupby("label"):
        x = np.stack(own.embedding.to_numpy()).astype(float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        n = (x @ x.T >= 0.98).sum(axis=1) - 1
        mine = got.loc[own.vec_id].to_numpy()
        assert (mine <= n).all()
        found, want = found + mine.sum(), want + n.sum()
    assert found >= 0.9 * want > 0

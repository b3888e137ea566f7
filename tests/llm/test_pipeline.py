import struct

import corpus_pipeline
from pitlane.llm import quality, registry, simhash, toxicity

from .test_packing import encoded

SF = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    """Each stage's decisions equal those of its operator on its own input, row by row."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "quality classifier", "simhash near-dedup", "packing"]

    rows = {r.doc_id: r for r in docs.collect()}
    model = toxicity.fit(docs, labels)
    want = {i for i, r in rows.items() if model.scores([r.text])[0] < 0.5}
    one = stages["toxicity"](spark, docs, SF)
    assert one.schema == docs.schema and {r.doc_id for r in one.collect()} == want

    model = quality.fit(one, labels)
    want = {i for i in want if model.scores([rows[i].text.encode()])[0] >= 0.7}
    two = stages["quality classifier"](spark, one, SF)
    assert two.schema == docs.schema and {r.doc_id for r in two.collect()} == want

    fps = {i: simhash.fingerprint(rows[i].text.encode()) for i in sorted(want)}
    left, group = set(), {}
    for i in fps:  # ascending: the smallest id of a group comes first
        todo = [i]
        if i in group:
            continue
        left.add(i)
        while todo:
            a = todo.pop()
            group[a] = i
            todo += [b for b in fps if b not in group and (fps[a] ^ fps[b]).bit_count() <= 3 and b not in todo]
    three = stages["simhash near-dedup"](spark, two, SF)
    assert three.columns == docs.columns and {r.doc_id for r in three.collect()} == left

    pieces = stages["packing"](spark, three, SF).collect()
    assert {p.doc_id for p in pieces} == left
    for i in sorted(left)[:5]:
        own = sorted((p.start, p.ids) for p in pieces if p.doc_id == i)
        ids = [t for _, b in own for t in struct.unpack(f"<{len(b) // 4}I", b)]
        assert ids == encoded(rows[i].text) + [0]
    assert sum(p.length for p in corpus_pipeline.run(spark, SF).collect()) == sum(p.length for p in pieces)


def test_odd_documents(odd_docs, no_docs, spark):
    for docs in (odd_docs, no_docs):
        for name, stage in corpus_pipeline.STAGES[:3]:
            docs = stage(spark, docs, SF)
            assert docs.columns == odd_docs.columns, name
        corpus_pipeline.STAGES[3][1](spark, docs, SF).count()


def test_registered():
    import __spark_entry__
    names = __spark_entry__.queries()
    assert set(registry.QUERIES) | {"pipeline"} <= set(names)
    assert {n.split("_")[0] for n in registry.QUERIES} == {f"op{k}" for k in range(1, 14)}
    assert set(registry.ORACLE) <= set(__spark_entry__.oracle_sql())

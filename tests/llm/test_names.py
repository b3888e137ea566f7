"""Every operator with extra columns of clashing names and of types without an order."""

import pytest

from pitlane.llm import forest, language, licences, negatives, pieces, quality, registry, simhash, topk, toxicity, urls
from tests.llm.conftest import CLASHING, with_clashes


def unchanged(out, before, new):
    """The caller's columns are as they were, but for those the operator returns."""
    old = [c for c in before.columns if c.lower() not in new]
    assert [c for c in out.columns if c not in new] == old
    for r in out.collect():
        assert r["m"] == {"k": 1} and all(r[c] == "x" for c in CLASHING if c in old)


@pytest.fixture(scope="module")
def pages(corpus):
    return with_clashes(corpus["pages"].select("page_id", "url").limit(60))


def test_urls_leave_other_columns_alone(pages):
    new = ("host", "path", "rule", "url_score", "verdict")
    out = urls.judged(pages, urls.RULES)
    unchanged(out, pages, new)
    plain = {r.page_id: (r.host, r.verdict) for r in urls.judged(pages.select("page_id", "url"), urls.RULES).collect()}
    assert {r.page_id: (r["host"], r["verdict"]) for r in out.collect()} == plain


def test_codes_and_languages(odd_docs):
    unchanged(pieces.coded(odd_docs, registry.tokenizer_file("piece_bpe_32k.model")), odd_docs, ("ids", "decoded"))
    unchanged(language.identified(odd_docs, language.fit(odd_docs)), odd_docs, ("lang_pred", "lang_score", "lang_shares"))


def test_classifiers(corpus, odd_docs):
    for op, new in ((quality, "quality"), (toxicity, "toxicity")):
        unchanged(op.scored(odd_docs, op.fit(corpus["documents"], corpus["labels"])), odd_docs, (new,))


def test_deduplicated_keeps_columns_and_one_row_of_repeated_ids(odd_docs):
    out = simhash.deduplicated(odd_docs)
    assert out.columns == odd_docs.columns
    rows = out.collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i in (1, 10, 2, 5, 7, 8, None))
    unchanged(out, odd_docs, ())


def test_scans_and_vectors(spark, odd_docs, corpus):
    assert licences.scanned(odd_docs, licences.known_licences(spark)).count() == odd_docs.count()
    plain = corpus["embeddings"].limit(60)
    vectors = with_clashes(plain)
    for op in (topk.top_k, forest.near_duplicates, negatives.mined):
        assert sorted(map(tuple, op(vectors).collect())) == sorted(map(tuple, op(plain).collect()))


def test_rows_of_one_id_have_their_own_notices(spark):
    notice = "Licensed under CC BY 4.0."
    rows = [(1, f"words here\n{notice}"), (1, f"words here {notice}"), (1, f"words here\n{notice}"), (None, f"a\n{notice}")]
    out = licences.scanned(spark.createDataFrame(rows, "doc_id long, text string"), licences.known_licences(spark)).collect()
    assert sorted((str(r.doc_id), tuple(r.notices)) for r in out) == [
        ("1", ()), ("1", ("CC-BY-4.0",)), ("1", ("CC-BY-4.0",)), ("None", ("CC-BY-4.0",))]
    assert len({r.text_digest for r in out if r.doc_id == 1}) == 1


def test_samples_hold_one_row_of_a_repeated_id(spark):
    from pitlane.llm.common import sample_by_label
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(i, "other") for i in range(2, 40)], "doc_id long, text string")
    keys = spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id long, toxic int")
    rows = sample_by_label(docs, keys, "toxic", 10, 1000).collect()
    assert len(rows) == 20 and len({r.doc_id for r in rows}) == 20
    assert [r.text for r in rows if r.doc_id == 1] in ([], ["text 0"])

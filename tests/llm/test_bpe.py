import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pitlane.llm import bpe, registry

FILE = registry.tokenizer_file("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def own():
    return bpe.PairEncoder(FILE)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_same_as_library(library, own, corpus):
    r = random.Random(4)
    texts = ["", None, " ", "  ", "x" * 400, "aaaa aaa aa a", " " * 300, "a<|endoftext|>b", "<|endoftext|>",
             " <|endoftext|> x<|endoftext|><|endoftext|>", "it's we'll 'S don't!'re", "a b　c d\u0085e",
             "a\x1cb \x1d c\x1f", "日本語 текст ñandú 😀\x00", "a\r\nb \r\n c\n", "tab\tx \t y", "1234 12a a12 ½ ²"]
    texts += ["".join(r.choice("  \n\t'aeinrstlmd,.!THE12日é😀 ") for _ in range(r.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(chr(r.choice([r.randint(1, 767), r.randint(1, 0xd7ff), r.randint(0xe000, 0x10ffff)]))
                      for _ in range(r.randint(0, 30))) for _ in range(1500)]
    texts += [d.text for d in corpus["documents"].limit(60).collect()]
    lists = own.encode(pa.array(texts))
    decoded = own.decode(lists).to_pylist()
    for text, ids, back in zip(texts, lists.to_pylist(), decoded):
        assert ids == ids_of(library, text)
        assert back == library.decode(ids, skip_special_tokens=False)


def test_bytes_that_are_no_text_decode_as_in_the_library(library, own):
    r = random.Random(5)
    lists = [[r.randrange(50257) for _ in range(r.randint(0, 12))] for _ in range(400)] + [[]]
    got = own.decode(pa.array(lists, pa.list_(pa.int32()))).to_pylist()
    assert got == [library.decode(x, skip_special_tokens=False) for x in lists]


def test_sliced_and_no_texts(library, own):
    texts = pa.array(["zero", "one two", None, "three  four", ""])
    assert own.encode(texts.slice(1, 3)).to_pylist() == [ids_of(library, t) for t in ("one two", None, "three  four")]
    assert own.encode(texts.slice(0, 0)).to_pylist() == []
    assert own.decode(own.encode(texts.slice(2, 1))).to_pylist() == [""]


def merged_plainly(symbols, merges):
    """The lowest-ranked pair, leftmost of equals, merged one at a time."""
    rank = {(a, b): (k, m) for k, (a, b, m) in enumerate(merges)}
    s = list(symbols)
    while True:
        best = min(((rank[p][0], i) for i, p in enumerate(zip(s, s[1:])) if p in rank), default=None)
        if best is None:
            return s
        i = best[1]
        s[i:i + 2] = [rank[s[i], s[i + 1]][1]]


def test_index_against_one_merge_at_a_time():
    r = random.Random(6)
    for _ in range(40):
        merges, size = [], 4
        while len(merges) < 25:
            a, b = r.randrange(size), r.randrange(size)
            if (a, b) not in [m[:2] for m in merges]:
                merges.append((a, b, size))
                size += 1
        words = [[r.randrange(4) for _ in range(r.randint(0, 30))] for _ in range(60)] + [[0] * 31, [1] * 8]
        flat = [-1]
        for w in words:
            flat += w + [-1]
        done = bpe.PairIndex(*map(np.array, zip(*merges))).apply(np.array(flat))
        cuts = np.flatnonzero(done == -1)
        got = [done[i + 1:j].tolist() for i, j in zip(cuts[:-1], cuts[1:])]
        assert got == [merged_plainly(w, merges) for w in words]


def test_merges_out_of_order_are_refused():
    with pytest.raises(ValueError):
        bpe.PairIndex(np.array([5, 0]), np.array([0, 1]), np.array([6, 5]))


def test_coded_rows_and_names(spark, odd_docs, no_docs, library):
    from pyspark.sql import functions as F
    odd = (odd_docs.withColumn("a.b", F.lit(1)).withColumn("made", F.lit("m")).withColumn("row", F.lit("r"))
           .withColumn("IDS", F.lit("x")).withColumn("m", F.create_map(F.lit("k"), F.lit(1))))
    out = bpe.coded(odd, FILE)
    assert out.columns == [c for c in odd.columns if c.lower() != "ids"] + ["ids", "decoded"]
    rows = out.collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert list(r.ids) == ids_of(library, r.text)
        assert r.decoded == (r.text or "") and (r.made, r.row, r["a.b"], r.m) == ("m", "r", 1, {"k": 1})
    assert bpe.coded(no_docs, FILE).collect() == []


def test_query(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    out = registry.op11_bpe(spark, "/root/testdata/sf0.001").collect()
    assert len(out) == len(docs)
    for r in out:
        ids = ids_of(library, docs[r.doc_id])
        text = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()

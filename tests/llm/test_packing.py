import struct
import zlib

from tokenizers import Tokenizer

from pitlane.llm import packing, registry

FILE = registry.tokenizer_file("byte_bpe_50k.json")


def encoded(text):
    return Tokenizer.from_file(FILE).encode(text or "", add_special_tokens=False).ids


def check(docs, length):
    rows = packing.packed(docs, FILE, length).collect()
    rows.sort(key=lambda r: (r.sequence_id, r.offset))
    at = 0
    for r in rows:  # gapless, in windows
        assert (r.sequence_id, r.offset) == divmod(at, length)
        assert 0 < r.length <= length - r.offset
        at += r.length
    by_doc = {}
    for r in rows:
        ids = list(struct.unpack(f"<{r.length}I", r.ids))
        by_doc.setdefault(r.doc_id, []).append((r.start, ids, r.doc_tokens))
    want = {}
    for d in docs.select("doc_id", "text").collect():
        want.setdefault(d.doc_id, []).append(encoded(d.text) + [0])
    assert by_doc.keys() == want.keys()
    for doc, texts in want.items():
        assert sum(len(p[1]) for p in by_doc[doc]) == sum(map(len, texts))
        if len(texts) == 1:
            got = [t for s, ids, _ in sorted(by_doc[doc]) for t in ids]
            assert got == texts[0]
            assert {p[2] for p in by_doc[doc]} == {len(got)}
            assert [p[0] for p in sorted(by_doc[doc])][0] == 0
    return rows


def test_round_trip_odd(odd_docs):
    check(odd_docs, 64)


def test_round_trip_given(corpus):
    rows = check(corpus["documents"], 1024)
    assert {r.padded_length for r in rows if r.sequence_id < rows[-1].sequence_id} == {1024}


def test_power_of_two_tail(spark):
    n = len(encoded("a b c")) + 1
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    (row,) = packing.packed(docs, FILE, 1024).collect()
    assert row.padded_length == (n if n & (n - 1) == 0 else 1024)


def test_empty(no_docs):
    assert packing.packed(no_docs, FILE).count() == 0


def test_query_digest(spark):
    rows = registry.op2_packing(spark, "/root/testdata/sf0.001").where("doc_id = 0 and start = 0").collect()
    text = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("doc_id = 0").first().text
    ids = (encoded(text) + [0])[:rows[0].length]
    assert rows[0].ids_crc32 == zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))


def test_words_beside_white_space():
    import pyarrow as pa
    enc = packing.ChunkEncoder(FILE)
    texts = ["of.\nThe", " a", "a ", "a  b", "a \n b", "x.\n\ny", "it's, don't!", "A!!! B*** c?", "<|endoftext|> a", "\x1c a"]
    import numpy as np
    got = [np.frombuffer(b, enc.dtype).tolist() for b in enc.encode(pa.array(texts)).to_pylist()]
    assert got == [encoded(t) for t in texts]

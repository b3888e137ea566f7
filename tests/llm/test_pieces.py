import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from pitlane.llm import pieces, registry

FILE = registry.tokenizer_file("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=FILE)


def test_same_as_library(library, corpus):
    r = random.Random(4)
    texts = ["", " ", "  ", "x" * 400, " " * 300, "▁a▁▁b", "a\x00b", "\n", "a\n\nb \n c", "<s> </s> <unk> <0x41>"]
    texts += ["".join(r.choice("  \n\taeinrst▁,.THE12日é😀") for _ in range(r.randint(0, 60))) for _ in range(1500)]
    texts += [d.text for d in corpus["documents"].limit(60).collect()]
    enc = pieces.MergeEncoder(FILE)
    got = [np.frombuffer(b, "<u4").tolist() for b in enc.encode(pa.array(texts)).to_pylist()]
    assert got == [library.encode(t, add_bos=True, add_eos=True) for t in texts]


def test_coded(odd_docs, library):
    out = pieces.coded(odd_docs, FILE).collect()
    assert len(out) == odd_docs.count()
    for r in out:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert ids == library.encode(r.text or "", add_bos=True, add_eos=True)
        assert r.decoded == library.decode(ids)


def test_empty(no_docs):
    assert pieces.coded(no_docs, FILE).count() == 0


def test_query(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in registry.op6_pieces(spark, "/root/testdata/sf0.001").collect():
        ids = library.encode(docs[r.doc_id], add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()

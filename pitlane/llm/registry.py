"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.llm import (bpe, forest, language, lexical, licences, negatives, packing, pieces, quality, simhash, topk,
                         toxicity, urls)
from pitlane.llm.common import held_out

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best inner products for every twentieth vector."""
    return topk.top_k(_table(spark, sf_dir, "embeddings"), every=20, k=20, scale=64)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 1024 ids; one row per piece."""
    out = packing.packed(_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), 1024)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                      "sequence_id", "offset", "padded_length")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    out = simhash.near_duplicates(_table(spark, sf_dir, "documents"), 3, 3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page's URL."""
    out = urls.judged(_table(spark, sf_dir, "pages").select("page_id", "url"), urls.RULES)
    return out.select("page_id", "host", "path", "rule", "verdict")


def op5_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of equal label at cosine 0.98."""
    return forest.near_duplicates(_table(spark, sf_dir, "embeddings"), 0.98)


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids and decoded text of every document, as digests."""
    out = pieces.coded(_table(spark, sf_dir, "documents").select("doc_id", "text"),
                       tokenizer_file("piece_bpe_32k.model"))
    return out.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences and licence notices that documents are or hold, by canonical digest."""
    out = licences.scanned(_table(spark, sf_dir, "documents"), licences.known_licences(spark))
    return out.withColumn("notices", F.array_join("notices", ","))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document; labels of the held-out quarter are not learned from."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    out = quality.scored(docs.select("doc_id", "text"), quality.fit(docs, labels))
    return out.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), F.col("quality").alias("score"),
                      (F.col("quality") >= 0.7).cast("int").alias("predicted"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of the held-out fifth are not learned from."""
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    out = toxicity.scored(docs.select("doc_id", "text"), toxicity.fit(docs, labels))
    return out.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), F.col("toxicity").alias("score"),
                      (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; the held-out quarter is not learned from."""
    docs = _table(spark, sf_dir, "documents")
    out = language.identified(docs.select("doc_id", "text"), language.fit(docs))
    return out.select("doc_id", held_out("doc_id", 4, 2).alias("held_out"), "lang_pred",
                      F.col("lang_score").alias("score"))


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids and decoded text of every document, as digests."""
    out = bpe.coded(_table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_file("byte_bpe_50k.json"))
    listed = F.array_join(F.col("ids").cast("array<string>"), ",")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best documents for every benchmark item."""
    return lexical.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives for every hundredth vector; labels of every seventh are moved on by one first."""
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.mined(_table(spark, sf_dir, "embeddings").withColumn("label", moved))


QUERIES: dict[str, Query] = {
    "op1_topk": op1_topk,
    "op2_packing": op2_packing,
    "op3_simhash": op3_simhash,
    "op4_urls": op4_urls,
    "op5_forest": op5_forest,
    "op6_pieces": op6_pieces,
    "op7_licences": op7_licences,
    "op8_quality": op8_quality,
    "op9_toxicity": op9_toxicity,
    "op10_language": op10_language,
    "op11_bpe": op11_bpe,
    "op12_lexical": op12_lexical,
    "op13_negatives": op13_negatives,
}

_USABLE = ("embedding IS NOT NULL AND len(embedding) > 0 AND "
           "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0")

_TERMS = ("coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), [])")

#: DuckDB SQL for the operators that SQL can express; the others are tested by brute force.
ORACLE: dict[str, str] = {
    "op1_topk": f"""
WITH v AS (SELECT vec_id, len(embedding) AS dim,
    list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS z FROM embeddings
  WHERE vec_id IS NOT NULL AND {_USABLE}),
n AS (SELECT *, row_number() OVER () AS r FROM v),
s AS (SELECT q.r AS qr, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.z, c.z) AS BIGINT) AS score
  FROM n q JOIN n c ON q.vec_id % 20 = 0 AND q.r <> c.r AND q.dim = c.dim)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY qr ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20""",
    "op5_forest": f"""
WITH RECURSIVE v AS (SELECT row_number() OVER () AS r, vec_id, label,
    CASE WHEN {_USABLE} THEN list_transform(embedding, lambda x: CAST(x AS DOUBLE)) END AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND list_dot_product(e, e) > 0),
link AS (SELECT a.r AS a, b.r AS b FROM ok a JOIN ok b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) END >= 0.98),
reach AS (SELECT r, r AS t FROM v UNION SELECT reach.r, link.b FROM reach JOIN link ON reach.t = link.a),
low AS (SELECT reach.r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.t GROUP BY reach.r),
degree AS (SELECT a AS r, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN low USING (r) LEFT JOIN degree USING (r)""",
    "op7_licences": licences.oracle_sql(),
    "op12_lexical": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents),
g AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM d),
i AS (SELECT row_number() OVER () AS q, item_id, {_TERMS} AS terms FROM benchmark),
asked AS (SELECT DISTINCT q, unnest(terms) AS term FROM i),
word AS (SELECT r, unnest(terms) AS term FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM word WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, g GROUP BY term, n_docs),
m AS (SELECT r, doc_id, 100 - 90 + ((90 * len(terms) * n_docs) // n_terms) AS m FROM d, g WHERE len(terms) > 0),
s AS (SELECT q, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM asked JOIN tf USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY q, r)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM s JOIN m USING (r) JOIN i USING (q) WHERE score > 0) WHERE rank <= 10""",
    "op13_negatives": f"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, len(embedding) AS dim,
    CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS z FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND {_USABLE}),
s AS (SELECT a.r AS anchor, a.vec_id AS anchor_id, c.r, c.vec_id, a.label = c.label AS same,
    CAST(list_dot_product(a.z, c.z) AS BIGINT) AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.r <> c.r AND a.dim = c.dim),
p AS (SELECT anchor, anchor_id, r AS positive, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, r) <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY anchor, positive ORDER BY s.score DESC, s.vec_id, s.r) AS rank
  FROM p JOIN s USING (anchor) WHERE NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 10""",
}

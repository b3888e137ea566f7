"""Corpus cleaning in four stages, each one of the dealt operators over whole tables.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
before the next one reads it. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.llm import packing, quality, simhash, toxicity
from pitlane.llm.common import quoted, stored
from pitlane.llm.registry import tokenizer_file


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator doesn't reject (score under 0.5)."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _kept(docs, toxicity.scored, model, F.col("toxicity") < 0.5)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject (score of 0.7 or more)."""
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return _kept(docs, quality.scored, model, F.col("quality") >= 0.7)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays (3-word shingles, 3 bits)."""
    return simhash.deduplicated(docs, 3, 3)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that stays, in sequences of 1024 ids: one row per piece, with its ids."""
    return packing.packed(docs, tokenizer_file("byte_bpe_50k.json"), 1024)


def _kept(docs: DataFrame, scored, model, condition) -> DataFrame:
    """Rows of ``docs`` that satisfy ``condition`` on their score, as they were."""
    whole = docs.select("text", F.struct(*[quoted(c).alias(c) for c in docs.columns]).alias("row"))
    return scored(whole, model).where(condition).select("row.*")


STAGES = [("toxicity", not_toxic), ("quality classifier", good_quality), ("simhash near-dedup", near_dedup),
          ("packing", pack)]

#: Trained scores can't be written in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage{k}")
    return docs

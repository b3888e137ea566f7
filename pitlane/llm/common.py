"""Helpers the operators share: scratch tables, code shipping, bounded labelled samples."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parents[2]
_SHIPPED: set[str] = set()
_HELD: dict = {}


def prepare(spark: SparkSession, batch_mb: int = 8) -> None:
    """Make this package importable in Python workers and bound Arrow batches.

    Whole texts travel in Arrow batches; the limit in bytes bounds a worker's
    memory also when many very long texts follow each other.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(batch_mb << 20))
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="pitlane-code-"), "pitlane_code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted((ROOT / "pitlane").rglob("*.py")):
            z.write(p, p.relative_to(ROOT))
    spark.sparkContext.addPyFile(archive)
    _SHIPPED.add(app)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` names.

    Only a local master may do without that setting; it then gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        root = tempfile.mkdtemp(prefix="pitlane-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there,
    so a lost executor never makes the steps before it run again."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tasks(spark: SparkSession) -> int:
    """Partitions for steps whose cost is computing, not bytes (AQE would merge them)."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")),
               2 * spark.sparkContext.defaultParallelism)


def quoted(name: str) -> Column:
    """The column of exactly this name, dots and back-ticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def appended(df: DataFrame, computed: Column, names: list[str]) -> DataFrame:
    """``df`` and the fields ``names`` of the struct ``computed``.

    The columns of ``df`` travel in a struct of their own, so no inner name meets one
    of theirs; those named like a new one (in any case) are replaced.
    """
    new = {n.lower() for n in names}
    kept = F.struct(*[quoted(c).alias(c) for c in df.columns if c.lower() not in new])
    return (df.select(kept.alias("row"), computed.alias("made"))
            .select("row.*", *[F.col(f"made.{n}").alias(n) for n in names]))


def held_out(doc_id: str, folds: int, fold: int):
    """crc32(doc_id as text) mod ``folds`` equals ``fold``; a null id is never held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == fold,
                      F.lit(False))


def sample_by_label(docs: DataFrame, keys: DataFrame, label: str, per_label: int,
                    max_bytes: int) -> DataFrame:
    """(doc_id, text, label) of at most ``per_label`` documents of each label value 0 and 1, one row each.

    ``keys`` (doc_id, label) are taken in the order of a hash of the id, so the
    sample is the same in every run. Twice as many ids are drawn as documents are
    kept, as texts of over ``max_bytes`` are left out of *training* only; the smallest ids stay. Of an id's
    texts the first counts, so what leaves the cluster is bounded by the parameters however often ids
    repeat. The drawn ids are bounded by them too, so broadcasting them is safe.
    """
    drawn = None
    for value in (0, 1):
        part = (keys.where((F.col(label) == value) & F.col("doc_id").isNotNull())
                .groupBy("doc_id").agg(F.max(label).alias("_label"))
                .orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * per_label))
        drawn = part if drawn is None else drawn.unionByName(part)
    texts = (docs.select("doc_id", "text")
             .where(F.col("text").isNotNull() & (F.octet_length("text") <= max_bytes)))
    single = (texts.join(F.broadcast(drawn), "doc_id").groupBy("doc_id")
              .agg(F.min("text").alias("text"), F.max("_label").alias("label")))
    nth = F.row_number().over(Window.partitionBy("label").orderBy("doc_id"))  # over at most 2 * per_label rows each
    return single.withColumn("nth", nth).where(F.col("nth") <= per_label).select("doc_id", "text", "label")


def held(key: tuple, build: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task (a tokenizer, a table of words).

    Only the last operator's is kept: workers live longer than a job, and what
    several operators remember would add up.
    """
    if key not in _HELD:
        pa.set_memory_pool(pa.system_memory_pool())  # what batches took goes back to the system
        _HELD.clear()
        _HELD[key] = build()
    return _HELD[key]

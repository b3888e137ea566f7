"""Incremental season load with Structured Streaming (stretch item E5).

Result extracts land as Parquet files in a folder; a file-source stream with
``trigger(availableNow=True)`` picks up every file not yet processed (tracked in
the checkpoint), and ``foreachBatch`` merges each micro-batch into the
season-partitioned fact: the stored rows of the seasons it touches are united
with the batch, a result id that comes again replaces its row, in whichever season that
is stored, and only those seasons are rewritten. A re-delivered batch merges to the same
rows, so the load survives a restart from its checkpoint and loses no earlier extract.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane.session import path_exists, scratch_path
from pitlane.sources.io import remove_partition, write_partitioned_fact


def touched_seasons(batch: DataFrame, target_path: str, key: str = "result_id", partition_col: str = "year") -> list:
    """The seasons a batch changes: those of its rows, and those in which its keys are stored now.

    Of the fact only keys and seasons are read; what comes back is a list of seasons.
    """
    spark = batch.sparkSession
    seasons = batch.select(partition_col)
    if path_exists(spark, target_path):
        stored = spark.read.schema(batch.schema).parquet(target_path).select(key, partition_col)
        seasons = seasons.unionByName(stored.join(batch.select(key), key, "left_semi").select(partition_col))
    return [r[0] for r in seasons.distinct().collect()]


def _of_seasons(partition_col: str, seasons: list) -> Column:
    """A filter that Spark answers by reading the named partitions only."""
    named = F.col(partition_col).isin([s for s in seasons if s is not None])
    return named | F.col(partition_col).isNull() if None in seasons else named


def merge_seasons(batch: DataFrame, target_path: str, key: str = "result_id",
                  partition_col: str = "year", seasons: list | None = None) -> DataFrame:
    """The batch and the stored rows of the seasons it touches; per ``key`` the newest row.

    A batch row wins over a stored one, also over one in another season; of several in one batch the first by
    its other columns. A row with a null key replaces only its equals in all columns.
    """
    spark = batch.sparkSession
    rows = batch.withColumn("_new", F.lit(1))
    if path_exists(spark, target_path):
        seasons = touched_seasons(batch, target_path, key, partition_col) if seasons is None else seasons
        kept = spark.read.schema(batch.schema).parquet(target_path).select(*batch.columns)
        kept = kept.where(_of_seasons(partition_col, seasons))
        rows = rows.unionByName(kept.withColumn("_new", F.lit(0)))
    others = [c for c in batch.columns if c != key]
    first = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("_new"), *others))
    named = rows.where(F.col(key).isNotNull()).withColumn("_nth", first).where(F.col("_nth") == 1)
    nameless = rows.where(F.col(key).isNull()).select(*batch.columns).dropDuplicates()
    return named.select(*batch.columns).unionByName(nameless)


def upsert_seasons(batch: DataFrame, target_path: str, key: str = "result_id", partition_col: str = "year") -> None:
    """Merge a batch into the season-partitioned fact, replacing the seasons it touches.

    A season that loses its last row to another one is removed after the others have been replaced. If the run
    dies in between, the batch comes again, finds its keys in the old season too, and ends the same way.
    """
    spark = batch.sparkSession
    if not path_exists(spark, target_path):  # nothing is read from the target, so nothing is written aside
        write_partitioned_fact(merge_seasons(batch, target_path, key, partition_col), target_path, partition_col)
        return
    seasons = touched_seasons(batch, target_path, key, partition_col)
    # Written aside first: the seasons that are read are the ones that get replaced.
    aside = scratch_path(spark, "season-merge")
    merge_seasons(batch, target_path, key, partition_col, seasons).write.parquet(aside)
    merged = spark.read.schema(batch.schema).parquet(aside)
    write_partitioned_fact(merged, target_path, partition_col)
    filled = {r[0] for r in merged.select(partition_col).distinct().collect()}
    for season in seasons:
        if season not in filled:
            remove_partition(spark, target_path, partition_col, season)


def incremental_season_load(spark: SparkSession, landing_dir: str, schema: T.StructType,
                            target_path: str, checkpoint_path: str,
                            partition_col: str = "year", key: str = "result_id") -> None:
    """Merge every file that has landed since the last run into the fact, then stop."""
    stream = spark.readStream.schema(schema).parquet(landing_dir)

    def upsert(batch: DataFrame, _epoch: int) -> None:
        if not batch.isEmpty():
            upsert_seasons(batch, target_path, key, partition_col)

    query = (stream.writeStream.foreachBatch(upsert)
             .option("checkpointLocation", checkpoint_path)
             .trigger(availableNow=True).start())
    query.awaitTermination()

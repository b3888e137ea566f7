"""Readers and writers for stage outputs."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane.session import path_exists


def counting(df: DataFrame, seen: Observation | None) -> DataFrame:
    """``df``, whose rows ``seen`` counts while they are written: no second scan, no count job.

    The counter must be the last step before the write; there a task that runs again counts once.
    """
    return df if seen is None else df.observe(seen, F.count(F.lit(1)).alias("rows"))


def rows_seen(seen: Observation) -> int:
    """The rows of the write that ``seen`` has watched; Spark plans nothing for a table known to be empty."""
    return seen.get.get("rows", 0)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", seen: Observation | None = None) -> str:
    """One dataset per table, replaced on every run."""
    w = counting(df, seen).write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True).option("escape", '"')
    w.save(path)
    return path


def write_partitioned_fact(df: DataFrame, path: str, partition_col: str = "year", seen: Observation | None = None) -> str:
    """The fact table partitioned by season.

    Rows are clustered by season with a rebalance hint: few files per season,
    and AQE splits a season that outgrows the advisory partition size over
    several tasks. Dynamic partition overwrite replaces only the seasons present
    in ``df``: re-running a load is idempotent and leaves other seasons untouched.
    """
    (counting(df.hint("rebalance", partition_col), seen).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))
    return path


def remove_partition(spark: SparkSession, path: str, partition_col: str, value) -> None:
    """Remove one partition of a written dataset, null's too; a missing one is no error."""
    jvm = spark._jvm  # noqa: SLF001 - partition names and deletes are only reachable through the gateway
    text = None if value is None else str(value)
    name = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(partition_col, text)
    folder = jvm.org.apache.hadoop.fs.Path(path, name)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)  # noqa: SLF001


def read_seasons(spark: SparkSession, path: str, seasons: list[int] | DataFrame, partition_col: str = "year") -> DataFrame:
    """Rows of some seasons of the partitioned fact; the others' files are never opened.

    A list becomes a partition filter, known before the scan. Of a frame the distinct values of ``partition_col`` count:
    they are joined, one row per season and so broadcast, and Spark prunes the partitions by those it turns
    out to hold.
    """
    fact = spark.read.parquet(path)
    if isinstance(seasons, DataFrame):
        wanted = seasons.select(F.col(partition_col).cast(fact.schema[partition_col].dataType).alias("wanted_")).distinct()
        return fact.join(F.broadcast(wanted), fact[partition_col] == F.col("wanted_"), "left_semi")
    return fact.where(F.col(partition_col).isin(list(seasons)))


def store_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str) -> DataFrame:
    """``df`` as a table hashed by ``keys`` into sorted buckets, at ``path``.

    Two tables with the same keys and buckets join on these keys without a shuffle of either: the write has paid
    for it once. Rows are dealt to the buckets before the write, so each bucket is one file. An existing table of
    this name is replaced.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    (df.repartition(buckets, *keys).write.format("parquet").mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", path).saveAsTable(table))
    return spark.table(table)


def replace_table(df: DataFrame, table: str, root: str) -> int:
    """Replace ``table`` by ``df``; returns its rows.

    The rows are written into a folder of their own under ``root`` first; then the catalog's table is pointed there
    in one step. Readers see the old table or the new one, never none or a half one, and a write that fails leaves
    the old one as it was. The version before stays for readers that have begun; older ones are removed.
    A table whose columns change is dropped and made anew, between two catalog calls, when all is written.
    """
    spark = df.sparkSession
    name = table.split(".")[-1]
    folder = f"{root.rstrip('/')}/{name}"
    path = f"{folder}/v-{uuid.uuid4().hex[:12]}"
    seen = Observation()
    write_table(df, path, seen=seen)
    before = None
    if spark.catalog.tableExists(table):
        before = _location(spark, table)
        if [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in df.schema]:
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
            spark.catalog.refreshTable(table)
        else:
            spark.sql(f"DROP TABLE {table}")
            spark.catalog.createTable(table, path=path, source="parquet")
    else:
        spark.catalog.createTable(table, path=path, source="parquet")
    _remove_versions(spark, folder, {path.rsplit("/", 1)[-1], (before or "").rstrip("/").rsplit("/", 1)[-1]})
    return rows_seen(seen)


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else ""


def _remove_versions(spark: SparkSession, folder: str, keep: set[str]) -> None:
    """Versions of a replaced table but for those in use."""
    jvm = spark._jvm  # noqa: SLF001
    parent = jvm.org.apache.hadoop.fs.Path(folder)
    fs = parent.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    for status in fs.listStatus(parent):
        name = status.getPath().getName()
        if name.startswith("v-") and name not in keep:
            fs.delete(status.getPath(), True)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None) -> DataFrame:
    """Read a stage output; a declared schema avoids inference for CSV."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Table not found: {path}")
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True).option("escape", '"')
        r = r.schema(schema) if schema is not None else r.option("inferSchema", False)
    elif schema is not None:
        r = r.schema(schema)
    return r.load(path)


def load_mart(spark: SparkSession, base: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet preferred, CSV fallback (with the mart's schema), else raise."""
    pq, csv = f"{base.rstrip('/')}/{name}.parquet", f"{base.rstrip('/')}/{name}.csv"
    if path_exists(spark, pq):
        return spark.read.parquet(pq)
    if path_exists(spark, csv):
        return read_table(spark, csv, "csv", schema)
    raise FileNotFoundError(f"Mart '{name}' not found in {base}")

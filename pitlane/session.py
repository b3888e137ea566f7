"""Session construction and shared-storage scratch locations."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: ANSI stays on (we use try_* functions
# everywhere), UTC session time, AQE for runtime re-planning and skew splits.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def get_spark(master: str | None = None, app: str = "pitlane",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session or build one with the library defaults.

    On a cluster the session is normally created by the launcher; this only
    fills in settings that are not already set there.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def compilable_code(spark: SparkSession) -> None:
    """Keep Spark's generated methods within what the JVM compiles, unless the session says otherwise.

    HotSpot leaves methods of over 8,000 bytes to its interpreter; the cast of a table of twenty text columns makes
    such a method. Spark then runs that step by smaller methods, with the same results.
    """
    if spark.conf.get(_METHOD_LIMIT) == "65535":  # Spark's default
        spark.conf.set(_METHOD_LIMIT, "8000")


#: Settings of a job of many written tables. Shuffle files go as soon as the write that needed them has ended, tables
#: are compressed by zstd, a task reads and sorts some 16 MB of a table, which its memory holds without spilling, and
#: rows for up to eight partitions are written without sorting them.
_LEAN = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.files.maxPartitionBytes": str(16 << 20),
    "spark.sql.files.openCostInBytes": str(1 << 20),
    "parquet.block.size": str(16 << 20),
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}


@contextmanager
def lean_on_disk(spark: SparkSession) -> Iterator[None]:
    """Run a job of many written tables with little disk: settings that the session doesn't make itself, for this long.

    Only frames that are written belong in here; one that is run again would have to make its shuffle files anew.
    """
    ours = [k for k in _LEAN if spark.conf.get(k, None) is None]
    for k in ours:
        spark.conf.set(k, _LEAN[k])
    try:
        yield
    finally:
        for k in ours:
            spark.conf.unset(k)


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder named by ``spark.checkpoint.dir``.

    The cluster names it. Only a local master, whose tasks all see one disk, may
    leave it unset; it then gets a private folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="pitlane-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem: a path without a scheme means
    the default file system, as it does for Spark's readers."""
    jvm = spark._jvm  # noqa: SLF001 - Hadoop FS is only reachable through the gateway
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())  # noqa: SLF001
    return bool(fs.exists(hpath))

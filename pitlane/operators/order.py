"""Places in a global order by range partitioning.

Rows are dealt to ranges of the whole sort key and sorted inside them, so equal values of its first
column spread over as many tasks as their later columns allow. The sorted rows are written once
with their position in their range; a place is that position after the sizes of the ranges before it. Only one
row per range (and group) is ever brought together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitlane.session import scratch_path

#: Bits of a row's number that count inside its partition (fixed by Spark's row numbers).
_INSIDE = 33


def _free(columns: list[str], base: str) -> str:
    """A name that no column has, in any case."""
    taken = {c.lower() for c in columns}
    while base in taken:
        base += "_"
    return base


def in_ranges(df: DataFrame, by: list[Column], at: str, ranges: int | None = None) -> DataFrame:
    """``df`` written in ranges of ``by``, each sorted; ``at`` is a row's range and position there in one number."""
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "ranges")
    rows = (df.repartitionByRange(n, *by).sortWithinPartitions(*by)
            .select("*", F.monotonically_increasing_id().alias(at)))
    rows.write.parquet(path)  # the ranges are drawn anew in each run: places need one fixed outcome
    return spark.read.schema(rows.schema).parquet(path)


def placed(df: DataFrame, by: list[Column], group: list[str] | None = None, out: str = "place",
           ranges: int | None = None) -> DataFrame:
    """``df`` and ``out``: the row's place (from 1) in the order ``by``, counted inside each ``group``.

    ``by`` should end with a key, as rows equal in all of it get their places in any order. Null
    groups are a group; nulls in ``by`` stand where its columns' null order puts them. An existing column ``out`` is
    replaced. ``ranges`` (default: the session's shuffle partitions) sets the number of tasks.
    """
    group = list(group or [])
    df = df.drop(out)
    at, part = (_free(df.columns, n) for n in ("_at", "_range"))
    first, before = (_free(df.columns, n) for n in ("_first", "_before"))
    rows = in_ranges(df, [*[F.asc_nulls_first(f"`{g}`") for g in group], *by], at, ranges)
    rows = rows.withColumn(part, F.shiftright(at, _INSIDE))
    inside = F.col(at).bitwiseAND(F.lit((1 << _INSIDE) - 1))
    keys = [part, *group]
    sizes = rows.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.min(inside).alias(first), F.count("*").alias("n"))
    # Without a group there is one row per range here.
    earlier = (Window.partitionBy(*[F.col(f"`{g}`") for g in group]).orderBy(part)
               .rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.withColumn(before, F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    sizes = sizes.select(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)], first, before)
    same = [rows[f"`{k}`"].eqNullSafe(sizes[f"k{i}"]) if i else rows[part] == sizes["k0"] for i, k in enumerate(keys)]
    place = F.col(before) + inside - F.col(first) + 1
    if not group:
        sizes = F.broadcast(sizes)  # a row per range: the ordered rows need no second shuffle
    return rows.join(sizes, same).select(*[F.col(f"`{c}`") for c in df.columns], place.cast("long").alias(out))

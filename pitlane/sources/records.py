"""Malformed records of raw CSV files: which ones, where, and what becomes of them.

A record is malformed if it has more or fewer fields than the header names or a field
that opens with a quote and doesn't end with one. Records with too few fields can still be
loaded, their last columns missing. The others can't, as no field of theirs is
certain to be in its column: they are refused, kept out of the table and listed with file and line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TOO_LONG, TOO_SHORT, BROKEN_QUOTE = "too_long", "too_short", "broken_quote"
#: Kinds that are refused unless a caller says otherwise.
REFUSED = (TOO_LONG, BROKEN_QUOTE)
SCHEMA = "file string, line long, kind string, fields int, record string"
#: A field in quotes, doubled ones inside, from a field's start to its end.
_QUOTED = r'(^|,)"(?:[^"]++|"")*+"(?=,|\z)'
#: A sign that no text holds: as separator it leaves records whole.
_NOWHERE = "\u0001"


class MalformedRecordsError(ValueError):
    """A raw file holds records that can't be loaded."""


def _unquoted(record: Column) -> Column:
    """The record without its well-formed quoted fields, whose commas part nothing."""
    return F.when(F.contains(record, F.lit('"')), F.regexp_replace(record, _QUOTED, "$1")).otherwise(record)


def field_count(record: Column) -> Column:
    rest = _unquoted(record)
    return F.octet_length(rest) - F.octet_length(F.replace(rest, F.lit(","), F.lit(""))) + 1


def kind_of(record: Column, fields: int) -> Column:
    """The kind of fault of a one-line record, null for none."""
    n = field_count(record)
    broken = F.contains(record, F.lit('"')) & F.regexp_like(_unquoted(record), F.lit('(^|,)"'))
    return F.when(broken, BROKEN_QUOTE).when(n > fields, TOO_LONG).when(n < fields, TOO_SHORT)


def is_refused(kind: Column, refused: tuple[str, ...] = REFUSED) -> Column:
    """Whether a record of this kind is kept out; the kind is found once per record, as a filter shares no work."""
    return F.coalesce(kind, F.lit("")).isin(*refused)


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line; no data is read."""
    return spark.read.option("header", True).option("escape", '"').csv(path).columns


def raw_records(spark: SparkSession, path: str) -> DataFrame:
    """The data lines of all files of ``path`` as one text column ``record``, each file's header left out."""
    lines = (spark.read.schema("value string, whole string").option("header", True).option("sep", _NOWHERE)
             .option("quote", "").option("columnNameOfCorruptRecord", "whole").csv(path))
    return lines.select(F.coalesce("whole", "value").alias("record"), F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_block_start").alias("start"))


def malformed_records(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, kind, fields, record) of every malformed record; lines count from 1, the header's.

    Line numbers need no sort and no task that reads a whole file: each split counts its lines, and a
    line's number is its place in its split after the sum of those before.
    """
    names = header_of(spark, path)
    if not names:
        return spark.createDataFrame([], SCHEMA)
    lines = spark.read.text(path).select(
        F.col("value").alias("record"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("at"))
    splits = lines.groupBy("file", "start").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    record = F.col("record")
    bad = lines.withColumn("kind", kind_of(record, len(names))).where(F.col("kind").isNotNull() & (F.trim(record) != ""))
    return (bad.join(splits, ["file", "start"])
            .withColumn("line", F.col("before") + F.col("at") - F.col("first") + 1).where("line > 1")
            .select("file", F.col("line").cast("long").alias("line"), "kind", field_count(record).alias("fields"), "record"))


def refuse_malformed(spark: SparkSession, path: str, refused: tuple[str, ...] = REFUSED, shown: int = 5) -> None:
    """Strict mode: raise MalformedRecordsError that names the first refused records by file and line."""
    bad = (malformed_records(spark, path).where(F.col("kind").isin(*refused))
           .orderBy("file", "line").limit(shown).collect())
    if bad:
        where = "; ".join(f"{r['file'].rsplit('/', 1)[-1]} line {r['line']}: {r['kind']} ({r['fields']} fields)" for r in bad)
        raise MalformedRecordsError(f"malformed records in {path}: {where}")

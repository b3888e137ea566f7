"""Ingestion: raw CSV read, contract check, metadata tags, era filter."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitlane.functions.exprs import to_long
from pitlane.session import path_exists, scratch_path
from pitlane.sources.contracts import (EXPECTED_COLUMNS, NULL_SENTINELS, RACE_LINKED,
                                       SchemaContractError, validate_schema)
from pitlane.sources.io import rows_seen, write_table
from pitlane.sources.records import (REFUSED, MalformedRecordsError, header_of, is_refused, kind_of,
                                     malformed_records, raw_records, refuse_malformed)
from pitlane.sources.records import SCHEMA as RECORD_SCHEMA

SEQ_COL = "_seq"


def null_sentinels(df: DataFrame, sentinels: tuple[str, ...] = NULL_SENTINELS) -> DataFrame:
    """Turn every sentinel text ('\\N', 'NULL', '', pandas NA words) into NULL."""
    words = list(dict.fromkeys(sentinels))
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            c = F.when(~c.isin(words), c)
        out.append(c.alias(f.name))
    return df.select(*out)


def tag_metadata(df: DataFrame, source_name: str) -> DataFrame:
    """Source tag and ingest time (session time zone is UTC)."""
    return df.withColumns({"_source": F.lit(source_name),
                           "_ingested_at": F.current_timestamp()})


def read_raw_csv(spark: SparkSession, path: str, quoted_newlines: bool = False,
                 refused: tuple[str, ...] = REFUSED) -> DataFrame:
    """Header CSV with every column as text, doubled quotes as escapes.

    No schema inference pass: only the header line is read to name the columns.
    Records of a ``refused`` kind (see ``records``) are left out, never cut to fit;
    ``quarantine`` lists them. The sequence column records the source
    order: the file, the split's place in it, then the line; a task that runs
    again reproduces it. ``quoted_newlines`` lets quoted fields hold line breaks,
    at the price of unsplittable files and of broken quotes being found only where
    they change the number of fields.
    """
    names = header_of(spark, path)
    seq = F.struct("file", "start", F.monotonically_increasing_id().alias("line")).alias(SEQ_COL)
    if quoted_newlines or not names:
        whole = "_record" + "_" * max(len(n) for n in [*names, ""])  # no column is called that
        schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, whole]])
        df = (spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", True)
              .option("columnNameOfCorruptRecord", whole).csv(path))
        place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")]
        columns = [F.col(f"`{n}`") for n in names]
        kind = kind_of(F.col(whole), len(names))
        return (df.select(F.struct(*columns, whole).alias("row"), kind.alias("kind"), *place)
                .where(~is_refused(F.col("kind"), refused))
                .select(*[F.col(f"row.`{n}`") for n in names], seq))
    row = F.from_csv("record", T.StructType([T.StructField(n, T.StringType()) for n in names]).toDDL(), {"escape": '"'})
    kind = kind_of(F.col("record"), len(names))
    return (raw_records(spark, path).where(~is_refused(kind, refused))
            .select(row.alias("row"), "file", "start").select("row.*", seq))


def load_raw_table(spark: SparkSession, table: str, raw_dir: str,
                   validate: bool = True, tag: bool = True, strict: bool = False) -> DataFrame:
    """Read ``{raw_dir}/{table}.csv``; a missing file raises FileNotFoundError.

    ``strict`` raises MalformedRecordsError if a record can't be loaded (this reads the file once more);
    otherwise such records are left out and stay listed by ``quarantine``.
    """
    path = _extract(spark, table, raw_dir)
    if strict:
        refuse_malformed(spark, path)
    return prepare_raw(read_raw_csv(spark, path), table, validate, tag)


def _extract(spark: SparkSession, table: str, raw_dir: str) -> str:
    path = f"{raw_dir.rstrip('/')}/{table}.csv"
    if not path_exists(spark, path):
        raise FileNotFoundError(f"no extract of table {table!r} at {path}")
    return path


def quarantine(spark: SparkSession, raw_dir: str, tables: Iterable[str] = tuple(EXPECTED_COLUMNS)) -> DataFrame:
    """(table, file, line, kind, fields, record, loaded): every malformed record of the extracts that are there.

    ``loaded`` tells the records that are in the table all the same, their last columns missing.
    """
    out = spark.createDataFrame([], f"table string, {RECORD_SCHEMA}, loaded boolean")
    for name in tables:
        try:
            bad = malformed_records(spark, _extract(spark, name, raw_dir))
        except FileNotFoundError:
            continue
        out = out.unionByName(bad.select(F.lit(name).alias("table"), "*", (~F.col("kind").isin(*REFUSED)).alias("loaded")))
    return out


def prepare_raw(df: DataFrame, table: str, validate: bool = True, tag: bool = True) -> DataFrame:
    """Sentinels to NULL, contract check and tags for an already-loaded raw frame."""
    df = null_sentinels(df)
    if validate:
        validate_schema(df, table)
    if tag:
        df = tag_metadata(df, table)
    return df


def ingest_all_tables(spark: SparkSession, raw_dir: str, validate: bool = True,
                      tag: bool = True, strict: bool = False) -> tuple[dict[str, DataFrame], DataFrame]:
    """S3: ingest every contracted table; keep going past missing files, contract errors and, if
    ``strict``, malformed records, which are reported in a small (table, status, error) frame."""
    tables: dict[str, DataFrame] = {}
    report = []
    for name in EXPECTED_COLUMNS:
        try:
            tables[name] = load_raw_table(spark, name, raw_dir, validate, tag, strict)
            report.append((name, "loaded", None))
        except FileNotFoundError as exc:
            report.append((name, "missing", str(exc)))
        except SchemaContractError as exc:
            report.append((name, "contract", str(exc)))
        except MalformedRecordsError as exc:
            report.append((name, "malformed", str(exc)))
    schema = "table string, status string, error string"
    return tables, spark.createDataFrame(report, schema)


def ingest_frames(frames: dict[str, DataFrame], validate: bool = True,
                  tag: bool = True) -> tuple[dict[str, DataFrame], list[tuple[str, str, str | None]]]:
    """S3 for raw frames that are already DataFrames (e.g. from another reader)."""
    tables: dict[str, DataFrame] = {}
    report: list[tuple[str, str, str | None]] = []
    for name, df in frames.items():
        try:
            tables[name] = prepare_raw(df, name, validate, tag)
            report.append((name, "loaded", None))
        except SchemaContractError as exc:
            report.append((name, "contract", str(exc)))
    return tables, report


def _long_col(df: DataFrame, name: str) -> Column:
    dtype = df.schema[name].dataType
    return to_long(F.col(name)) if isinstance(dtype, T.StringType) else F.col(name).cast("long")


def era_races(races: DataFrame, start_year: int = 2000, end_year: int = 2024) -> DataFrame:
    """Races with start_year <= year <= end_year."""
    return races.where(_long_col(races, "year").between(start_year, end_year))


class KeptRaces:
    """The ids of an era's races, written once and read by every table that is filtered by them."""

    #: Ids up to which the set is broadcast: 8 bytes each, so at most some tens of MB.
    BROADCAST_MAX = 4_000_000

    def __init__(self, races: DataFrame):
        ids = races.select(_long_col(races, "raceId").alias("_era_race_id")).where("_era_race_id IS NOT NULL").distinct()
        spark, seen = races.sparkSession, Observation()
        path = write_table(ids, scratch_path(spark, "kept-races"), seen=seen)
        self.size = rows_seen(seen)
        self.ids = spark.read.schema(ids.schema).parquet(path)

    def of(self, df: DataFrame) -> DataFrame:
        """Rows of ``df`` whose race was kept.

        The size was counted as the set was written: a calendar is broadcast, and no table is shuffled. A set beyond
        the bound is joined by Spark, which may send a Bloom filter of it ahead of the shuffle.
        """
        ids = F.broadcast(self.ids) if self.size <= self.BROADCAST_MAX else self.ids
        return df.join(ids, _long_col(df, "raceId") == F.col("_era_race_id"), "left_semi")


def era_filter_table(df: DataFrame, name: str, kept_races: DataFrame, kept: KeptRaces | None = None) -> DataFrame:
    """P2 for one table: race-linked rows of kept races only; others untouched."""
    if name == "races":
        return kept_races
    if name in RACE_LINKED and "raceId" in df.columns:
        return (kept or KeptRaces(kept_races)).of(df)
    return df


def filter_modern_era(tables: dict[str, DataFrame], start_year: int = 2000,
                      end_year: int = 2024) -> dict[str, DataFrame]:
    """P1 + P2: filter races to the era and keep only race-linked rows of kept races.

    Dimension tables pass through untouched. A missing ``races`` table raises KeyError. The kept races are found
    once, whatever the number of tables.
    """
    if "races" not in tables:
        raise KeyError("races")
    races = era_races(tables["races"], start_year, end_year)
    kept = KeptRaces(races)
    return {name: era_filter_table(df, name, races, kept) for name, df in tables.items()}


def save_tables(tables: dict[str, DataFrame], output_dir: str, fmt: str = "parquet",
                suffix: str = "") -> dict[str, str]:
    """One dataset per table, overwrite; CSV gets a header row and no helper columns."""
    paths = {}
    for name, df in tables.items():
        path = f"{output_dir.rstrip('/')}/{name}{suffix}"
        df = df.drop(SEQ_COL) if fmt == "csv" else df
        w = df.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            w = w.option("header", True).option("escape", '"')
        w.save(path)
        paths[name] = path
    return paths

"""Data checks: uniqueness and not-null tests as DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.session import scratch_path

# --- fixed values: the data tests of the SQL models -------------------------
UNIQUE_TESTS = [
    ("stg_results", "result_id"), ("stg_drivers", "driver_id"), ("stg_constructors", "constructor_id"),
    ("stg_races", "race_id"), ("stg_circuits", "circuit_id"), ("stg_qualifying", "qualify_id"),
    ("mart_driver_performance", "driver_id"), ("mart_season_overview", "year"),
    ("mart_circuit_stats", "circuit_id"),
]
NOT_NULL_TESTS = [
    ("stg_results", "result_id"), ("stg_results", "race_id"), ("stg_results", "driver_id"),
    ("stg_drivers", "driver_id"), ("stg_constructors", "constructor_id"),
    ("stg_races", "race_id"), ("stg_races", "year"), ("stg_circuits", "circuit_id"),
    ("stg_qualifying", "qualify_id"), ("stg_pit_stops", "race_id"), ("stg_pit_stops", "driver_id"),
    ("mart_driver_performance", "driver_id"), ("mart_driver_performance", "races_entered"),
    ("mart_driver_performance", "points_total"), ("mart_team_performance", "constructor_id"),
    ("mart_team_performance", "year"), ("mart_season_overview", "year"), ("mart_circuit_stats", "circuit_id"),
]


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _by_model(tests: list[tuple[str, str]]) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    for model, col in tests:
        out.setdefault(model, []).append(col)
    return out


def _keyed(model: DataFrame, tests: dict[int, str]) -> DataFrame:
    """(test, key): the non-null values of the tested columns as text, one pass over the model."""
    return model.select(F.inline(F.array(*[
        F.struct(F.lit(i).alias("test"), F.col(c).cast("string").alias("key")) for i, c in tests.items()]))) \
        .where("key IS NOT NULL")


def unique_violations(models: dict[str, DataFrame], tests=UNIQUE_TESTS) -> DataFrame:
    """Q1: per test, keys seen more than once and their rows (NULL keys are not checked).

    All tests of all models are counted by 64-bit hashes of their keys, each model being read once; partial
    counts are combined map-side, so a key that repeats often costs a row per task. Only hashes seen more than
    once, equal keys or colliding ones, are looked at again: their keys are counted exactly. Where keys are
    unique, as they should be, no key is ever moved and no model read twice.
    """
    tests = list(tests)
    of_model: dict[str, dict[int, str]] = {}
    for i, (model, col) in enumerate(tests):
        of_model.setdefault(model, {})[i] = col
    spark = next(iter(models.values())).sparkSession
    hashed = _union([_keyed(models[m], own).select("test", F.xxhash64("key").alias("h")) for m, own in of_model.items()])
    path = scratch_path(spark, "repeated-hashes")
    (hashed.groupBy("test", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
     .select("test", "h").write.parquet(path))
    repeated = spark.read.schema("test int, h long").parquet(path)
    suspect = {r["test"] for r in repeated.select("test").distinct().collect()}  # at most one row per test
    named = spark.createDataFrame([(i, m, c) for i, (m, c) in enumerate(tests)], "test int, model string, column string")
    again = {m: {i: c for i, c in own.items() if i in suspect} for m, own in of_model.items()}
    if not suspect:
        zero = F.lit(0).cast("long")
        return named.select("model", "column", zero.alias("duplicate_keys"), zero.alias("duplicate_rows"))
    keyed = _union([_keyed(models[m], own) for m, own in again.items() if own]).withColumn("h", F.xxhash64("key"))
    exact = (keyed.join(repeated, ["test", "h"], "left_semi").groupBy("test", "key").agg(F.count(F.lit(1)).alias("n"))
             .where("n > 1").groupBy("test").agg(F.count(F.lit(1)).alias("duplicate_keys"), F.sum("n").alias("duplicate_rows")))
    return named.join(exact, "test", "left").na.fill(0).select("model", "column", "duplicate_keys", "duplicate_rows")


def not_null_violations(models: dict[str, DataFrame], tests=NOT_NULL_TESTS) -> DataFrame:
    """Q2: NULL counts per tested column, one scan per model."""
    parts = []
    for model, cols in _by_model(tests).items():
        counts = models[model].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        stack = ", ".join(f"'{c}', `{c}`" for c in cols)
        parts.append(counts.selectExpr(f"stack({len(cols)}, {stack}) AS (column, null_rows)")
                     .select(F.lit(model).alias("model"), "column", "null_rows"))
    return _union(parts)


def table_row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows per table as one report frame (each count is a scan)."""
    return _union([df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows")
                   for n, df in tables.items()])

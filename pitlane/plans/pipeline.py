"""End-to-end pipeline: ingest, era filter, clean, write, build marts, write (Q3, M5).

Each stage's output is written to storage and the next stage reads it back,
as the reference pipeline does between its stages. That cuts the lineage:
a lost executor only re-runs work of the current stage, and each mart reads
compact typed Parquet instead of re-parsing raw text.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from typing import TypeVar

from pyspark.sql import DataFrame, Observation, SparkSession

from pitlane.operators.clean import clean_all_tables
from pitlane.operators.marts import build_all_marts
from pitlane.session import compilable_code, lean_on_disk
from pitlane.sources.contracts import RACE_LINKED
from pitlane.sources.ingest import filter_modern_era, ingest_all_tables, ingest_frames, save_tables
from pitlane.sources.io import rows_seen, write_partitioned_fact, write_table

T = TypeVar("T")

DEFAULTS = {"start_year": 2000, "end_year": 2024, "output_format": "parquet", "validate_schema": True,
            "min_races": 5, "era_snapshot_dir": None}


def stage_ingest(spark: SparkSession, raw: str | Mapping[str, DataFrame], cfg: dict) -> dict[str, DataFrame]:
    """Raw CSV folder (or raw frames) -> checked, tagged, era-filtered frames."""
    if isinstance(raw, str):
        tables, _ = ingest_all_tables(spark, raw, validate=cfg["validate_schema"])
    else:
        tables, _ = ingest_frames(dict(raw), validate=cfg["validate_schema"])
    return filter_modern_era(tables, cfg["start_year"], cfg["end_year"])


def in_parallel(jobs: dict[str, Callable[[], T]], at_once: int = 8) -> dict[str, T]:
    """Run independent table jobs a few at a time; small ones then share the cluster.

    The first error is raised after the running ones have ended.
    """
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: job.result() for name, job in running.items()}


def stage_clean(spark: SparkSession, tables: dict[str, DataFrame], processed_dir: str,
                snapshot_dir: str | None = None) -> dict[str, DataFrame]:
    """Clean every table, write it, and hand the written tables to the next stage.

    With ``snapshot_dir`` each raw table is kept there first (S5) and cleaned from what was kept. Tables don't wait for
    each other: one is cleaned while another's snapshot is still being written.
    """
    base = processed_dir.rstrip("/")

    def one(name: str, df: DataFrame) -> DataFrame:
        if snapshot_dir:
            df = spark.read.schema(df.schema).parquet(save_tables({name: df}, snapshot_dir, suffix="_era")[name])
        df = clean_all_tables({name: df})[name]
        return spark.read.schema(df.schema).parquet(write_table(df, f"{base}/{name}_clean"))

    # The facts take longest, so they go first.
    order = sorted(tables, key=lambda n: n not in RACE_LINKED)
    return in_parallel({n: partial(one, n, tables[n]) for n in order})


def stage_transform(spark: SparkSession, marts: dict[str, DataFrame], output_dir: str, fmt: str) -> dict[str, int]:
    """Write the marts; the fact table is partitioned by season (Parquet only). Rows by mart, counted by the writes.

    The fact shuffles as much as all other marts together, so it goes when their shuffle files have gone.
    """
    def one(name: str, df: DataFrame) -> int:
        base, seen = f"{output_dir.rstrip('/')}/{name}", Observation()
        if fmt == "parquet" and name == "fact_race_results" and "year" in df.columns:
            write_partitioned_fact(df, f"{base}.parquet", seen=seen)
        else:
            write_table(df, f"{base}.{fmt}", fmt, seen)
        return rows_seen(seen)

    small = in_parallel({n: partial(one, n, df) for n, df in marts.items() if n != "fact_race_results"})
    return {n: small[n] if n in small else one(n, df) for n, df in marts.items()}


def run_pipeline(spark: SparkSession, raw: str | Mapping[str, DataFrame], processed_dir: str,
                 output_dir: str, **overrides) -> DataFrame:
    """Q3: all stages in order, failing fast; returns (table, rows) of the written marts.

    ``era_snapshot_dir`` also keeps the era-filtered raw tables (S5); the cleaners
    then read that snapshot.
    """
    compilable_code(spark)
    cfg = {**DEFAULTS, **overrides}
    with lean_on_disk(spark):
        tables = stage_ingest(spark, raw, cfg)
        cleaned = stage_clean(spark, tables, processed_dir, cfg["era_snapshot_dir"])
        marts = build_all_marts(cleaned, min_races=cfg["min_races"])
        rows = stage_transform(spark, marts, output_dir, cfg["output_format"])
    return spark.createDataFrame(list(rows.items()), "table string, rows long")

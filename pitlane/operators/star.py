"""Star schema: five dimensions and a narrow fact (D-1..D-7, S13, S14)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.functions import exprs as X
from pitlane.operators.order import placed
from pitlane.operators.clean import remove_duplicates, select_existing
from pitlane.operators.marts import qualifying_positions
from pitlane.sources.io import replace_table

# --- fixed values: columns and key of each dimension, columns of the fact
DIM_COLUMNS = {
    "dim_drivers": (["driver_id", "driver_ref", "number", "code", "forename", "surname",
                     "full_name", "dob", "nationality"], "driver_id"),
    "dim_constructors": (["constructor_id", "constructor_ref", "name", "nationality"], "constructor_id"),
    "dim_circuits": (["circuit_id", "circuit_ref", "name", "location", "country", "lat", "lng", "alt"],
                     "circuit_id"),
    "dim_races": (["race_id", "year", "round", "circuit_id", "name", "date", "season_round"], "race_id"),
}

NARROW_FACT_COLUMNS = ["result_id", "race_id", "driver_id", "constructor_id",
                       "grid", "qualifying_position", "position_numeric", "position_order",
                       "points", "laps", "milliseconds", "status_id",
                       "finished", "positions_gained"]


def build_dimension(df: DataFrame, name: str) -> DataFrame:
    """D-1..D-4: ordered projection, one row per id (W1, deterministic first)."""
    cols, key = DIM_COLUMNS[name]
    return remove_duplicates(select_existing(df, cols), [key])


def build_dim_date(races: DataFrame) -> DataFrame:
    """D-5: one row per distinct race date with calendar attributes.

    Unsorted, as a table; ``calendar`` gives it in date order (K13)."""
    d = races.select("date").where(F.col("date").isNotNull()).distinct()
    return d.select(
        "date",
        F.year("date").cast("long").alias("year"),
        F.month("date").cast("long").alias("month"),
        F.dayofmonth("date").cast("long").alias("day"),
        X.day_name("date").alias("day_of_week"),
        F.quarter("date").cast("long").alias("quarter"),
        F.weekofyear("date").cast("long").alias("week_of_year"),
        X.is_weekend("date").alias("is_weekend"),
    )


def calendar(dim_date: DataFrame) -> DataFrame:
    """The date dimension sorted by date, with each date's ``place``; sorted in ranges, by many tasks."""
    return placed(dim_date, [F.asc("date")]).orderBy("place")


def build_star_fact(results: DataFrame, qualifying: DataFrame) -> DataFrame:
    """D-6: narrow fact with qualifying position and positions gained."""
    fact = results.join(qualifying_positions(qualifying), ["race_id", "driver_id"], "left")
    fact = fact.withColumn("positions_gained", X.positions_gained("grid", "position_numeric"))
    return select_existing(fact, NARROW_FACT_COLUMNS)


def build_star(cleaned: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """D-7: the whole star schema as lazy DataFrames."""
    return {
        "dim_drivers": build_dimension(cleaned["drivers"], "dim_drivers"),
        "dim_constructors": build_dimension(cleaned["constructors"], "dim_constructors"),
        "dim_circuits": build_dimension(cleaned["circuits"], "dim_circuits"),
        "dim_races": build_dimension(cleaned["races"], "dim_races"),
        "dim_date": build_dim_date(cleaned["races"]),
        "fact_race_results": build_star_fact(cleaned["results"], cleaned["qualifying"]),
    }


def write_star_schema(spark: SparkSession, star: dict[str, DataFrame], database: str,
                      location: str | None = None) -> DataFrame:
    """Replace each star table; (table, rows), counted by the writes themselves.

    A table is replaced in one step when all of it is written: readers never find it missing or half. The fact
    table isn't partitioned here; it is joined on ids, not pruned by season.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{location}'" if location else ""))
    root = spark.catalog.getDatabase(database).locationUri
    rows = [(name, replace_table(df, f"{database}.{name}", root)) for name, df in star.items()]
    return spark.createDataFrame(rows, "table string, rows long")

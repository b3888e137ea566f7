"""Raw table contracts: column names every source CSV must carry.

Types are not part of the contract: raw columns are read as strings and typed
by the cleaners with ``try_*`` casts, so there is no inference pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# --- fixed values: required raw column names per source table -------------
EXPECTED_COLUMNS: dict[str, list[str]] = {
    "results": ["resultId", "raceId", "driverId", "constructorId", "number", "grid",
                "position", "positionText", "positionOrder", "points", "laps",
                "time", "milliseconds", "fastestLap", "rank", "fastestLapTime",
                "fastestLapSpeed", "statusId"],
    "drivers": ["driverId", "driverRef", "number", "code", "forename", "surname",
                "dob", "nationality", "url"],
    "constructors": ["constructorId", "constructorRef", "name", "nationality", "url"],
    "races": ["raceId", "year", "round", "circuitId", "name", "date", "time", "url",
              "fp1_date", "fp1_time", "fp2_date", "fp2_time", "fp3_date", "fp3_time",
              "quali_date", "quali_time", "sprint_date", "sprint_time"],
    "circuits": ["circuitId", "circuitRef", "name", "location", "country", "lat", "lng",
                 "alt", "url"],
    "driver_standings": ["driverStandingsId", "raceId", "driverId", "points", "position",
                         "positionText", "wins"],
    "constructor_standings": ["constructorStandingsId", "raceId", "constructorId", "points",
                              "position", "positionText", "wins"],
    "qualifying": ["qualifyId", "raceId", "driverId", "constructorId", "number",
                   "position", "q1", "q2", "q3"],
    "pit_stops": ["raceId", "driverId", "stop", "lap", "time", "duration", "milliseconds"],
    "lap_times": ["raceId", "driverId", "lap", "position", "time", "milliseconds"],
    "status": ["statusId", "status"],
    "constructor_results": ["constructorResultsId", "raceId", "constructorId", "points", "status"],
    "sprint_results": ["resultId", "raceId", "driverId", "constructorId", "number", "grid",
                       "position", "positionText", "positionOrder", "points", "laps",
                       "time", "milliseconds", "fastestLap", "fastestLapTime", "statusId"],
    "seasons": ["year", "url"],
}

# --- fixed values: tables whose rows belong to one race and therefore follow the era filter.
RACE_LINKED = ("results", "driver_standings", "constructor_standings", "qualifying",
               "pit_stops", "lap_times", "constructor_results", "sprint_results")

# --- fixed values: text read as missing -----------------------------------
# The source null marker and its escaped form, plus pandas' default NA words.
NULL_SENTINELS = ("\\N", "\\\\N", "NULL", "",
                  "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                  "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NaN", "None", "n/a",
                  "nan", "null")

METADATA_COLUMNS = ("_source", "_ingested_at")


class SchemaContractError(ValueError):
    """A raw table lacks required columns."""


def missing_columns(df: DataFrame, table: str) -> list[str]:
    """Required columns absent from ``df``; unknown tables have no contract."""
    have = set(df.columns)
    return [c for c in EXPECTED_COLUMNS.get(table, []) if c not in have]


def validate_schema(df: DataFrame, table: str) -> DataFrame:
    """Raise when required columns are missing; extra columns are allowed."""
    missing = missing_columns(df, table)
    if missing:
        raise SchemaContractError(
            f"table {table!r} lacks required columns: {', '.join(sorted(missing))}")
    return df

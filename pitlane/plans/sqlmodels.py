"""SQL layer: staging views and SQL marts in Spark SQL.

Staging models are projections of the cleaned tables: frames with declared types, or
CSV files whose types are inferred (``csv_staging``). Marts are Spark SQL over them. Rounding follows the SQL engine the models
were written for: half away from zero on the scaled binary value (``_round``), and
percentages use a DOUBLE literal so Spark does not switch to DECIMAL arithmetic.
Sort orders are applied only where a mart is shown: a sorted mart costs a range
shuffle that a table write does not need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.functions import exprs as X
from pitlane.sources.io import replace_table
from pitlane.sources.typed import register_csv_sources

# --- fixed values: staging projections -------------------------------------
STAGING_COLUMNS: dict[str, list[str]] = {
    "stg_results": ["result_id", "race_id", "driver_id", "constructor_id", "grid", "position_numeric",
                    "position_order", "points", "laps", "milliseconds", "status_id", "finished",
                    "positions_gained"],
    "stg_drivers": ["driver_id", "driver_ref", "number", "code", "forename", "surname", "full_name",
                    "dob", "nationality"],
    "stg_constructors": ["constructor_id", "constructor_ref", "name", "nationality"],
    "stg_races": ["race_id", "year", "round", "circuit_id", "name", "date", "season_round"],
    "stg_circuits": ["circuit_id", "circuit_ref", "name", "location", "country", "lat", "lng", "alt"],
    "stg_qualifying": ["qualify_id", "race_id", "driver_id", "constructor_id", "position",
                       "q1_ms", "q2_ms", "q3_ms"],
    "stg_pit_stops": ["race_id", "driver_id", "stop", "lap", "duration", "milliseconds", "is_long_stop"],
}

_STAGING_SOURCE = {"stg_results": "results", "stg_drivers": "drivers", "stg_constructors": "constructors",
                   "stg_races": "races", "stg_circuits": "circuits", "stg_qualifying": "qualifying",
                   "stg_pit_stops": "pit_stops"}


def _round(expr: str, k: int) -> str:
    """SQL text for round-half-away-from-zero of a DOUBLE to k decimals."""
    p = f"{float(10 ** k)}D"
    y = f"(CAST({expr} AS DOUBLE) * {p})"
    return (f"(signum({y}) * (floor(abs({y})) + CASE WHEN abs({y}) - floor(abs({y})) >= 0.5D "
            f"THEN 1.0D ELSE 0.0D END) / {p})")


def staging(cleaned, views: list[str] | None = None) -> dict[str, DataFrame]:
    """The staging models (all seven by default) over the cleaned tables.

    ``positions_gained`` is computed here: the results cleaner does not
    produce it, yet the results staging model selects it.
    """
    out = {}
    for view, src in _STAGING_SOURCE.items():
        if views is not None and view not in views:
            continue
        df = cleaned[src]
        if view == "stg_results" and "positions_gained" not in df.columns:
            df = df.withColumn("positions_gained", X.positions_gained("grid", "position_numeric"))
        out[view] = df.select(*STAGING_COLUMNS[view])
    return out


def source_of(view: str) -> str:
    """The cleaned table that a staging model reads."""
    return _STAGING_SOURCE[view]


def staging_sql(view: str, source: str | None = None) -> str:
    """SQL text of a staging model over the view or table ``source`` (default: its source table's name)."""
    gained = "rint(grid - position_numeric) AS positions_gained"
    columns = ", ".join(gained if c == "positions_gained" else c for c in STAGING_COLUMNS[view])
    return f"SELECT {columns} FROM {source or _STAGING_SOURCE[view]}"


def csv_staging(spark: SparkSession, folder: str, views: list[str] | None = None, prefix: str = "csv_") -> dict[str, DataFrame]:
    """The staging models in SQL over the cleaned tables' CSV files, whose types are inferred from all rows."""
    views = views or list(STAGING_COLUMNS)
    register_csv_sources(spark, folder, [_STAGING_SOURCE[v] for v in views], prefix=prefix)
    return {v: spark.sql(staging_sql(v, prefix + _STAGING_SOURCE[v])) for v in views}


def register_staging(cleaned, prefix: str, views: list[str] | None = None) -> dict[str, DataFrame]:
    """The staging models as temp views, for ad-hoc SQL. The models themselves get
    their inputs as DataFrames; ``prefix`` keeps the views of two folders apart."""
    out = staging(cleaned, views)
    for view, df in out.items():
        df.createOrReplaceTempView(prefix + view)
    return out


# The models group by (key, race) first: one row per entrant and race then makes
# distinct races a plain count, and attributes are joined after the last grouping.
# {stg_*} are DataFrames handed to spark.sql.

def mart_driver_performance_sql(min_races: int = 5) -> str:
    """M6: career figures per driver with enough races."""
    share = lambda n: _round(f"100.0D * {n} / nullif(career.starts, 0)", 2)
    return f"""
SELECT career.driver_id, who.full_name, who.code, who.nationality,
       career.first_season, career.last_season, career.seasons_active,
       career.starts AS races_entered, career.won AS wins, career.placed AS podiums, career.lost AS dnf_count,
       career.scored AS points_total,
       {_round('career.scored / nullif(career.starts, 0)', 3)} AS points_per_race,
       {share('career.won')} AS win_rate_pct, {share('career.placed')} AS podium_rate_pct,
       {share('career.lost')} AS dnf_rate_pct,
       {_round('career.grid_total / career.grid_known', 2)} AS avg_grid,
       {_round('career.finish_total / career.finish_known', 2)} AS avg_finish
FROM (
  SELECT driver_id, count(*) AS starts, count(DISTINCT season) AS seasons_active,
         min(season) AS first_season, max(season) AS last_season,
         sum(won) AS won, sum(placed) AS placed, sum(lost) AS lost, sum(scored) AS scored,
         sum(grid_total) AS grid_total, nullif(sum(grid_known), 0) AS grid_known,
         sum(finish_total) AS finish_total, nullif(sum(finish_known), 0) AS finish_known
  FROM (
    SELECT entry.driver_id, entry.race_id, max(race.year) AS season,
           count_if(position_numeric = 1) AS won, count_if(position_numeric <= 3) AS placed,
           count_if(finished = 0) AS lost, sum(points) AS scored,
           sum(CAST(grid AS DOUBLE)) AS grid_total, count(grid) AS grid_known,
           sum(position_numeric) AS finish_total, count(position_numeric) AS finish_known
    FROM {{stg_results}} AS entry JOIN {{stg_races}} AS race USING (race_id)
    GROUP BY entry.driver_id, entry.race_id)
  GROUP BY driver_id HAVING count(*) >= {int(min_races)}) AS career
LEFT JOIN {{stg_drivers}} AS who ON who.driver_id = career.driver_id"""


def mart_team_performance_sql() -> str:
    """M7: one row per team and season."""
    share = lambda n: _round(f"100.0D * ({n}) / nullif(season.entries, 0)", 2)
    return f"""
SELECT season.constructor_id, team.name, team.nationality, season.year, season.races, season.entries,
       season.won AS wins, season.placed AS podiums, season.first_rows AS poles, season.lost AS dnf_count,
       season.drivers_used, season.scored AS points_total,
       {_round('season.scored / nullif(season.races, 0)', 3)} AS points_per_race,
       {share('season.won')} AS win_rate_pct, {share('season.placed')} AS podium_rate_pct,
       {share('season.entries - season.lost')} AS reliability_pct
FROM (
  SELECT constructor_id, year, count(DISTINCT race_id) AS races, count(DISTINCT driver_id) AS drivers_used,
         sum(entries) AS entries, sum(won) AS won, sum(placed) AS placed, sum(first_rows) AS first_rows,
         sum(lost) AS lost, sum(scored) AS scored
  FROM (
    SELECT entry.constructor_id, race.year, entry.race_id, entry.driver_id, count(*) AS entries,
           count_if(position_numeric = 1) AS won, count_if(position_numeric <= 3) AS placed,
           count_if(grid = 1) AS first_rows, count_if(finished = 0) AS lost, sum(points) AS scored
    FROM {{stg_results}} AS entry JOIN {{stg_races}} AS race USING (race_id)
    GROUP BY entry.constructor_id, race.year, entry.race_id, entry.driver_id)
  GROUP BY constructor_id, year) AS season
LEFT JOIN {{stg_constructors}} AS team ON team.constructor_id = season.constructor_id"""


def mart_season_overview_sql() -> str:
    """M8: one row per season."""
    return f"""
SELECT year, count(DISTINCT race_id) AS total_races, count(DISTINCT driver_id) AS total_drivers,
       count(DISTINCT constructor_id) AS total_constructors, sum(won) AS total_wins,
       {_round('sum(scored) / nullif(sum(scores), 0)', 2)} AS avg_points_per_entry,
       sum(lost) AS total_dnfs, {_round('100.0D * sum(lost) / nullif(sum(entries), 0)', 2)} AS dnf_rate_pct
FROM (
  SELECT race.year, entry.race_id, entry.driver_id, entry.constructor_id, count(*) AS entries,
         count_if(position_numeric = 1) AS won, count_if(finished = 0) AS lost,
         sum(points) AS scored, count(points) AS scores
  FROM {{stg_results}} AS entry JOIN {{stg_races}} AS race USING (race_id)
  GROUP BY race.year, entry.race_id, entry.driver_id, entry.constructor_id)
GROUP BY year"""


def mart_circuit_stats_sql() -> str:
    """M9: one row per circuit that held a race."""
    return f"""
SELECT place.circuit_id, place.name AS circuit_name, place.country, place.location,
       held.races AS races_held, held.first_year AS first_race_year, held.last_year AS last_race_year,
       {_round('held.scored / nullif(held.scores, 0)', 2)} AS avg_points_per_entry, held.lost AS total_dnfs,
       {_round('100.0D * held.lost / nullif(held.entries, 0)', 2)} AS dnf_rate_pct,
       {_round('held.finish_total / nullif(held.finish_known, 0)', 2)} AS avg_finishing_position
FROM (
  SELECT race.circuit_id, count(*) AS races, min(race.year) AS first_year, max(race.year) AS last_year,
         sum(entries) AS entries, sum(lost) AS lost, sum(scored) AS scored, sum(scores) AS scores,
         sum(finish_total) AS finish_total, sum(finish_known) AS finish_known
  FROM (
    SELECT race_id, count(*) AS entries, count_if(finished = 0) AS lost, sum(points) AS scored,
           count(points) AS scores, sum(position_numeric) AS finish_total, count(position_numeric) AS finish_known
    FROM {{stg_results}} GROUP BY race_id) AS per_race
  JOIN {{stg_races}} AS race USING (race_id)
  GROUP BY race.circuit_id) AS held
JOIN {{stg_circuits}} AS place ON place.circuit_id = held.circuit_id"""


SQL_MARTS = {
    "mart_driver_performance": (mart_driver_performance_sql, ["stg_results", "stg_races", "stg_drivers"]),
    "mart_team_performance": (mart_team_performance_sql, ["stg_results", "stg_races", "stg_constructors"]),
    "mart_season_overview": (mart_season_overview_sql, ["stg_results", "stg_races"]),
    "mart_circuit_stats": (mart_circuit_stats_sql, ["stg_results", "stg_races", "stg_circuits"]),
}

# --- sort orders of the SQL marts, applied where they are shown (K1, K3-K5) ---
SQL_MART_ORDER = {
    "mart_driver_performance": "points_total DESC, driver_id",
    "mart_team_performance": "year, points_total DESC, constructor_id",
    "mart_season_overview": "year",
    "mart_circuit_stats": "races_held DESC, circuit_id",
}


def sql_mart(spark: SparkSession, name: str, models, **options) -> DataFrame:
    """One SQL mart over its staging models (a mapping of name to DataFrame)."""
    text, inputs = SQL_MARTS[name]
    return spark.sql(text(**options), **{i: models[i] for i in inputs})


def ordered_sql_mart(mart: DataFrame, name: str) -> DataFrame:
    """K1, K3-K5: the mart in presentation order; ids break ties."""
    return mart.orderBy(*[F.expr(p.removesuffix(" DESC")).desc() if p.endswith(" DESC") else F.expr(p)
                          for p in SQL_MART_ORDER[name].split(", ")])


def save_sql_marts(spark: SparkSession, models, database: str) -> dict[str, int]:
    """Every SQL mart as a table of ``database``, replaced on each run in one step; rows by table."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    root = spark.catalog.getDatabase(database).locationUri
    return {f"{database}.{name}": replace_table(sql_mart(spark, name, models), f"{database}.{name}", root)
            for name in SQL_MARTS}

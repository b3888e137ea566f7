"""Analytical marts over the cleaned tables (M1-M5).

Plan shape, chosen for scale:
* results is the only large input; races, drivers, constructors are
  dimensions joined after aggregation, so their joins run on small frames;
  the results x races(year) join is left to AQE, which broadcasts the race
  calendar at runtime.
* the driver mart aggregates in two levels, (driver, season) then driver:
  every career metric is additive over seasons, so one shuffle with map-side
  combine feeds all of them, best-season points included.
* the season mart uses one pass over the final standings (conditional
  aggregates) instead of three merges, and the Herfindahl index is
  sum(w^2) / (sum w)^2 from one aggregate instead of a share self-join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.functions import exprs as X
from pitlane.operators.clean import select_existing


def _with_year(results: DataFrame, races: DataFrame) -> DataFrame:
    """Results with the race's season (left join: unmatched results keep NULL)."""
    return results.join(races.select("race_id", "year"), "race_id", "left")


# ---------------------------------------------------------------------------
# M1 driver performance
# ---------------------------------------------------------------------------

# --- fixed values: column order of the driver mart
DRIVER_MART_COLUMNS = [
    "driver_id", "full_name", "code", "nationality", "dob",
    "first_season", "last_season", "seasons_active",
    "races_entered", "wins", "podiums", "dnf_count",
    "points_total", "best_season_points", "points_per_race",
    "win_rate_pct", "podium_rate_pct", "dnf_rate_pct",
    "avg_grid", "avg_finish", "avg_qualifying_ms", "avg_pit_stop_s",
]


def driver_season_points(results: DataFrame, races: DataFrame) -> DataFrame:
    """A8 level 1: one row per (driver, season) with additive career parts."""
    res = _with_year(results, races).where(F.col("driver_id").isNotNull())
    pos = F.col("position_numeric")
    return res.groupBy("driver_id", "year").agg(
        F.count_distinct("race_id").alias("races"),
        F.count_if(pos == 1).alias("wins"),
        F.count_if(pos <= 3).alias("podiums"),
        F.sum("points").alias("points"),
        F.count_if(F.col("finished") == 0).alias("dnfs"),
        F.sum(F.col("grid").cast("double")).alias("grid_sum"),
        F.count("grid").alias("grid_n"),
        F.sum(pos).alias("pos_sum"),
        F.count(pos).alias("pos_n"),
    )


def driver_best_season(per_season: DataFrame) -> DataFrame:
    """A8 level 2: peak single-season points per driver, 2 decimals."""
    return per_season.where(F.col("year").isNotNull()).groupBy("driver_id").agg(
        X.round_half_even(F.max(F.coalesce("points", F.lit(0.0))), 2).alias("best_season_points"))


def driver_avg_qualifying(qualifying: DataFrame) -> DataFrame:
    """Mean best-of-three qualifying time per driver, 1 decimal."""
    q = qualifying.where(F.col("driver_id").isNotNull()) \
        .select("driver_id", X.best_of("q1_ms", "q2_ms", "q3_ms").alias("best_q_ms"))
    return q.groupBy("driver_id").agg(X.round_half_even(F.avg("best_q_ms"), 1).alias("avg_qualifying_ms"))


def driver_avg_pit_stop(pit_stops: DataFrame) -> DataFrame:
    """A10 + P12: mean normal (not long) stop per driver, 3 decimals.

    Only the mean is rounded. The sum runs over decimals of a nanosecond, which
    is the same in any order of rows; a sum of doubles is not.
    """
    normal = pit_stops.where((F.col("is_long_stop") == 0) & F.col("driver_id").isNotNull())
    total = F.sum(F.col("duration").cast("decimal(20,9)")).cast("double")
    return normal.groupBy("driver_id").agg(
        X.round_half_even(X.safe_div(total, F.count("duration")), 3).alias("avg_pit_stop_s"))


def build_driver_performance_mart(results: DataFrame, drivers: DataFrame, races: DataFrame,
                                  qualifying: DataFrame, pit_stops: DataFrame,
                                  min_races: int = 5) -> DataFrame:
    """M1: one row per driver with at least ``min_races`` distinct races."""
    per_season = driver_season_points(results, races)
    agg = per_season.groupBy("driver_id").agg(
        F.sum("races").alias("races_entered"),
        F.sum("wins").alias("wins"),
        F.sum("podiums").alias("podiums"),
        F.coalesce(F.sum("points"), F.lit(0.0)).alias("points_total"),
        F.sum("dnfs").alias("dnf_count"),
        X.safe_div(F.sum("grid_sum"), F.sum("grid_n")).alias("avg_grid"),
        X.safe_div(F.sum("pos_sum"), F.sum("pos_n")).alias("avg_finish"),
        F.count("year").alias("seasons_active"),
        F.min("year").alias("first_season"),
        F.max("year").alias("last_season"),
        F.max(F.when(F.col("year").isNotNull(), F.coalesce("points", F.lit(0.0)))).alias("best_season_points"),
    ).where(F.col("races_entered") >= min_races)
    agg = agg.withColumns({
        "win_rate_pct": X.pct("wins", "races_entered"),
        "podium_rate_pct": X.pct("podiums", "races_entered"),
        "dnf_rate_pct": X.pct("dnf_count", "races_entered"),
        "points_per_race": X.round_half_even(X.safe_div("points_total", "races_entered"), 3),
        "avg_grid": X.round_half_even("avg_grid", 2),
        "avg_finish": X.round_half_even("avg_finish", 2),
        "best_season_points": X.round_half_even("best_season_points", 2),
    })
    meta = drivers.select("driver_id", "full_name", "code", "nationality", "dob")
    out = (agg.join(driver_avg_qualifying(qualifying), "driver_id", "left")
           .join(driver_avg_pit_stop(pit_stops), "driver_id", "left")
           .join(meta, "driver_id", "left"))
    return select_existing(out, DRIVER_MART_COLUMNS)


# ---------------------------------------------------------------------------
# M2 team performance
# ---------------------------------------------------------------------------

# --- fixed values: column order of the team mart
TEAM_MART_COLUMNS = [
    "constructor_id", "name", "nationality", "year",
    "races", "entries", "wins", "podiums", "poles", "dnf_count", "drivers_used",
    "points_total", "points_per_race", "wcc_position",
    "win_rate_pct", "podium_rate_pct", "reliability_pct",
]


def season_final_race(races: DataFrame, order_by: str = "race_id") -> DataFrame:
    """The last race of each season (by max race id, or by round).

    Output: (year, last_race_id). Calendar-sized.
    """
    r = races.where(F.col("year").isNotNull())
    if order_by == "race_id":
        return r.groupBy("year").agg(F.max("race_id").alias("last_race_id"))
    return r.groupBy("year").agg(F.max_by("race_id", F.struct(order_by, "race_id")).alias("last_race_id"))


def final_standings(standings: DataFrame, races: DataFrame) -> DataFrame:
    """Standings rows taken after the season's last race, with the year."""
    last = season_final_race(races)
    return standings.join(last, standings.race_id == last.last_race_id, "inner").drop("last_race_id")


def build_team_performance_mart(results: DataFrame, constructor_standings: DataFrame,
                                constructors: DataFrame, races: DataFrame) -> DataFrame:
    """M2: one row per constructor and season."""
    res = _with_year(results, races).where(F.col("constructor_id").isNotNull() & F.col("year").isNotNull())
    pos = F.col("position_numeric")
    agg = res.groupBy("constructor_id", "year").agg(
        F.count_distinct("race_id").alias("races"),
        F.count_if(pos == 1).alias("wins"),
        F.count_if(pos <= 3).alias("podiums"),
        F.count_if(F.col("grid") == 1).alias("poles"),
        F.coalesce(F.sum("points"), F.lit(0.0)).alias("points_total"),
        F.count_if(F.col("finished") == 0).alias("dnf_count"),
        F.count("result_id").alias("entries"),
        F.count_distinct("driver_id").alias("drivers_used"),
    )
    agg = agg.withColumns({
        "win_rate_pct": X.round_half_even(X.pct("wins", "entries"), 2),
        "podium_rate_pct": X.round_half_even(X.pct("podiums", "entries"), 2),
        "reliability_pct": X.round_half_even(X.pct(F.col("entries") - F.col("dnf_count"), "entries"), 2),
        "points_per_race": X.round_half_even(X.round_half_even(X.safe_div("points_total", "races"), 3), 2),
    })
    wcc = final_standings(constructor_standings, races).select(
        "constructor_id", "year", F.col("position").alias("wcc_position"))
    meta = constructors.select("constructor_id", "name", "nationality")
    out = agg.join(wcc, ["constructor_id", "year"], "left").join(meta, "constructor_id", "left")
    return select_existing(out, TEAM_MART_COLUMNS)


# ---------------------------------------------------------------------------
# M3 season trends
# ---------------------------------------------------------------------------

# --- fixed values: column order of the season mart
SEASON_MART_COLUMNS = ["year", "total_races", "total_drivers", "total_constructors",
                       "wdc_driver", "wdc_points", "wcc_team", "wcc_points",
                       "dominance_hhi", "wdc_margin_pts"]


def season_entries(results: DataFrame, races: DataFrame) -> DataFrame:
    """One row per (season, driver, constructor) with its race wins: all that the
    season counts and the win concentration need, from one pass over results."""
    return (_with_year(results, races).where(F.col("year").isNotNull())
            .groupBy("year", "driver_id", "constructor_id")
            .agg(F.count_if(F.col("position_numeric") == 1).alias("wins")))


def season_counts(results: DataFrame, races: DataFrame) -> DataFrame:
    """Races per season from the calendar, drivers and teams from results."""
    people = season_people(season_entries(results, races)).drop("dominance_hhi")
    return season_calendar(races).join(people, "year", "left")


def season_hhi(results: DataFrame, races: DataFrame) -> DataFrame:
    """Herfindahl index of race wins per season, 4 decimals."""
    hhi = season_people(season_entries(results, races)).select("year", "dominance_hhi")
    return hhi.where(F.col("dominance_hhi").isNotNull())


def season_calendar(races: DataFrame) -> DataFrame:
    """Races per season."""
    return races.where(F.col("year").isNotNull()).groupBy("year") \
        .agg(F.count_distinct("race_id").alias("total_races"))


def season_people(entries: DataFrame) -> DataFrame:
    """Per season: drivers, teams and win concentration, from one pass over ``entries``.

    Two grouping sets, by driver and by team, are summed up per season; the index is
    sum(w^2) / (sum w)^2 over the drivers' wins, NULL in a season without a winner.
    """
    both = (entries.groupingSets([["year", "driver_id"], ["year", "constructor_id"]],
                                 "year", "driver_id", "constructor_id")
            .agg(F.sum("wins").alias("w"), F.grouping("driver_id").alias("by_team")))
    w = F.when((F.col("by_team") == 0) & F.col("driver_id").isNotNull(), F.col("w")).cast("double")
    out = both.groupBy("year").agg(
        F.count(F.when(F.col("by_team") == 0, F.col("driver_id"))).alias("total_drivers"),
        F.count(F.when(F.col("by_team") == 1, F.col("constructor_id"))).alias("total_constructors"),
        F.sum(w * w).alias("w2"), F.sum(w).alias("wt"))
    hhi = X.round_half_even(X.safe_div("w2", F.col("wt") * F.col("wt")), 4)
    return out.select("year", "total_drivers", "total_constructors", hhi.alias("dominance_hhi"))


def season_champions(driver_standings: DataFrame, constructor_standings: DataFrame,
                     races: DataFrame, drivers: DataFrame, constructors: DataFrame) -> DataFrame:
    """Champions and the P1-P2 points margin per season.

    One pass over each final standings table with conditional aggregates.
    A season without a position-2 row has a NULL margin; tied P1 rows (not
    expected in standings) resolve to the smallest id.
    """
    d = final_standings(driver_standings, races).groupBy("year").agg(
        F.min(F.when(F.col("position") == 1, F.col("driver_id"))).alias("wdc_driver_id"),
        F.max(F.when(F.col("position") == 1, F.col("points"))).alias("wdc_points"),
        F.max(F.when(F.col("position") == 2, F.col("points"))).alias("p2_points"))
    c = final_standings(constructor_standings, races).groupBy("year").agg(
        F.min(F.when(F.col("position") == 1, F.col("constructor_id"))).alias("wcc_id"),
        F.max(F.when(F.col("position") == 1, F.col("points"))).alias("wcc_points"))
    d = d.join(drivers.select(F.col("driver_id").alias("wdc_driver_id"), F.col("full_name").alias("wdc_driver")),
               "wdc_driver_id", "left")
    c = c.join(constructors.select(F.col("constructor_id").alias("wcc_id"), F.col("name").alias("wcc_team")),
               "wcc_id", "left")
    margin = X.round_half_even(F.col("wdc_points") - F.col("p2_points"), 1)
    d = d.select("year", "wdc_driver", F.when(F.col("wdc_driver_id").isNotNull(), F.col("wdc_points")).alias("wdc_points"),
                 margin.alias("wdc_margin_pts"))
    c = c.select("year", "wcc_team", F.when(F.col("wcc_id").isNotNull(), F.col("wcc_points")).alias("wcc_points"))
    return d.join(c, "year", "full")


def build_season_trends_mart(results: DataFrame, driver_standings: DataFrame, races: DataFrame,
                             drivers: DataFrame, constructors: DataFrame,
                             constructor_standings: DataFrame) -> DataFrame:
    """M3: one row per season with champions, margin and win concentration."""
    champs = season_champions(driver_standings, constructor_standings, races, drivers, constructors)
    out = (season_calendar(races).join(season_people(season_entries(results, races)), "year", "left")
           .join(champs, "year", "left"))
    return select_existing(out, SEASON_MART_COLUMNS)


# ---------------------------------------------------------------------------
# M4 wide fact, M5 all marts
# ---------------------------------------------------------------------------

# --- fixed values: column order of the wide fact
FACT_COLUMNS = [
    "result_id", "race_id", "season_round", "year", "round", "name", "date", "circuit_id",
    "driver_id", "constructor_id",
    "grid", "qualifying_position", "position_numeric", "position_order", "position_text",
    "points", "laps", "milliseconds", "fastest_lap_time", "fastest_lap_speed",
    "finished", "positions_gained", "status_id",
]


def qualifying_positions(qualifying: DataFrame) -> DataFrame:
    return qualifying.select("race_id", "driver_id", F.col("position").alias("qualifying_position"))


def build_fact_race_results(results: DataFrame, races: DataFrame, qualifying: DataFrame) -> DataFrame:
    """M4: one row per result with race metadata and qualifying position."""
    meta = select_existing(races, ["race_id", "year", "round", "circuit_id", "name", "date", "season_round"])
    # The calendar comes last: its columns don't go through the shuffle by race and driver.
    res = results.join(qualifying_positions(qualifying), ["race_id", "driver_id"], "left") \
        .join(meta, "race_id", "left")
    res = res.withColumn("positions_gained", X.positions_gained("grid", "position_numeric"))
    return select_existing(res, FACT_COLUMNS)


# --- sort orders of the marts, applied where they are shown (K1-K3) ----------
MART_ORDER = {
    "driver_performance_mart": [F.desc_nulls_last, "points_total", "driver_id"],
    "team_performance_mart": [F.asc_nulls_last, "year", "wcc_position", "constructor_id"],
    "season_trends_mart": [F.asc_nulls_last, "year"],
}


def ordered(mart: DataFrame, name: str) -> DataFrame:
    """K1-K3: the mart in presentation order; ids break ties. Stored marts stay unsorted."""
    direction, first, *rest = MART_ORDER[name]
    return mart.orderBy(direction(first), *[F.asc_nulls_last(c) for c in rest])


def build_all_marts(cleaned: dict[str, DataFrame], min_races: int = 5) -> dict[str, DataFrame]:
    """M5: the four marts; required inputs are checked up front."""
    need = ["results", "drivers", "races", "qualifying", "pit_stops",
            "constructor_standings", "constructors", "driver_standings"]
    missing = [n for n in need if n not in cleaned]
    if missing:
        raise KeyError(f"Missing cleaned tables: {missing}")
    t = cleaned
    return {
        "driver_performance_mart": build_driver_performance_mart(
            t["results"], t["drivers"], t["races"], t["qualifying"], t["pit_stops"], min_races),
        "team_performance_mart": build_team_performance_mart(
            t["results"], t["constructor_standings"], t["constructors"], t["races"]),
        "season_trends_mart": build_season_trends_mart(
            t["results"], t["driver_standings"], t["races"], t["drivers"], t["constructors"],
            t["constructor_standings"]),
        "fact_race_results": build_fact_race_results(t["results"], t["races"], t["qualifying"]),
    }

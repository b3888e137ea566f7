"""Chart feeds and insights: the result tables behind the charts.

Rendering is not part of the library; each feed is the DataFrame a chart is
drawn from. A global maximum is a scalar subquery; medians are exact and come from
rank selection in rounds (``quantiles``), which read the frame several times: pass a stored one.
Top-k uses ``orderBy(...).limit(k)`` (TakeOrderedAndProject: per-partition
top-k, then a k-row merge) with the key as the last sort column for ties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitlane.functions import exprs as X
from pitlane.operators.order import placed
from pitlane.operators.quantiles import quantiles

# --- fixed values: highlighted surnames of the charts -----------------------
WIN_PODIUM_HIGHLIGHT = ["Hamilton", "Verstappen", "Vettel", "Schumacher", "Alonso", "Räikkönen", "Rosberg"]
DNF_HIGHLIGHT = ["Hamilton", "Verstappen", "Vettel", "Schumacher", "Alonso"]


def _scalars(df: DataFrame, **aggs: F.Column) -> dict[str, F.Column]:
    """Global aggregates of ``df`` as scalar subqueries of one row."""
    row = df.agg(F.struct(*[a.alias(n) for n, a in aggs.items()]).alias("s")).scalar()
    return {n: row.getField(n) for n in aggs}


def _medians(df: DataFrame, **columns: str) -> dict[str, F.Column]:
    """Exact medians of columns of ``df``, as literals."""
    found = quantiles(df, list(columns.values()), [0.5])
    return {n: F.lit(found[c][0]).cast("double") for n, c in columns.items()}


def feed_top_drivers(drivers: DataFrame, k: int = 15) -> DataFrame:
    """Top k drivers by career points, the leader flagged."""
    top = drivers.orderBy(F.desc("points_total"), F.asc("driver_id")).limit(k)
    # k rows: an unpartitioned window over them is bounded by k.
    rank = F.row_number().over(Window.orderBy(F.desc("points_total"), F.asc("driver_id")))
    return top.select(rank.cast("long").alias("rank"), "driver_id", "full_name", "points_total",
                      (rank == 1).alias("is_leader"))


def _qualified(drivers: DataFrame, min_races: int) -> DataFrame:
    return drivers.where(F.col("races_entered") >= min_races).withColumn("surname", X.surname("full_name"))


def feed_win_vs_podium(drivers: DataFrame, min_races: int = 50, size_base: float = 50.0,
                       highlight: list[str] = WIN_PODIUM_HIGHLIGHT) -> DataFrame:
    """Win rate vs podium rate for drivers with enough starts."""
    q = _qualified(drivers, min_races)
    g = _scalars(q, max_n=F.max("races_entered")) | _medians(q, podium="podium_rate_pct", win="win_rate_pct")
    return q.select(
        "driver_id", "surname", "podium_rate_pct", "win_rate_pct", "points_per_race", "races_entered",
        (F.col("races_entered") / g["max_n"] * F.lit(900.0) + F.lit(size_base)).alias("bubble_size"),
        F.col("surname").isin(highlight).alias("highlight"),
        g["podium"].alias("median_podium_rate"), g["win"].alias("median_win_rate"))


def feed_hhi_bands(seasons: DataFrame, competitive_max: float = 0.18, dominant_min: float = 0.35,
                   top: int = 3) -> DataFrame:
    """Dominance index per season with band, champion surname and top-k flag.

    One row per season: the unpartitioned rank window is bounded by the
    number of seasons.
    """
    rank = F.row_number().over(Window.orderBy(F.desc_nulls_last("dominance_hhi"), F.asc("year")))
    return seasons.select(
        "year", "dominance_hhi", X.hhi_band("dominance_hhi", competitive_max, dominant_min).alias("band"),
        X.surname("wdc_driver").alias("wdc_surname"),
        ((rank <= top) & F.col("dominance_hhi").isNotNull()).alias("is_peak"))


def team_totals(teams: DataFrame) -> DataFrame:
    """Points per team name over all seasons."""
    return teams.where(F.col("name").isNotNull()).groupBy("name") \
        .agg(F.coalesce(F.sum("points_total"), F.lit(0.0)).alias("total_points"))


def feed_team_points(teams: DataFrame, k: int = 5) -> DataFrame:
    """Season points of the top-k teams, with each team's latest-season points."""
    top = team_totals(teams).orderBy(F.desc("total_points"), F.asc("name")).limit(k)
    rows = teams.join(top.select("name"), "name", "left_semi")
    # Shown ordered by name and season; the label is the newest season's value.
    last = rows.groupBy("name").agg(F.max_by("points_total", "year").alias("latest_points"),
                                    F.max("year").alias("latest_year"))
    place = F.row_number().over(Window.partitionBy("name").orderBy("year"))
    return (rows.select("name", "year", "points_total", place.cast("long").alias("nth_season"))
            .join(last.withColumn("label", X.first_token("name")), "name", "left"))


def feed_dnf_vs_points(drivers: DataFrame, min_races: int = 30,
                       highlight: list[str] = DNF_HIGHLIGHT) -> DataFrame:
    """DNF rate vs points per race with medians."""
    q = _qualified(drivers, min_races)
    g = _medians(q, dnf="dnf_rate_pct", points="points_per_race")
    return q.select(
        "driver_id", "surname", "nationality", "dnf_rate_pct", "points_per_race",
        F.col("surname").isin(highlight).alias("highlight"),
        g["dnf"].alias("median_dnf_rate"), g["points"].alias("median_points_per_race"))


def feed_nationality_counts(drivers: DataFrame, min_races: int = 30, k: int = 7) -> DataFrame:
    """The k most common nationalities among qualified drivers."""
    q = _qualified(drivers, min_races).where(F.col("nationality").isNotNull())
    return q.groupBy("nationality").agg(F.count(F.lit(1)).alias("drivers")) \
        .orderBy(F.desc("drivers"), F.asc("nationality")).limit(k)


def feed_wdc_margin(seasons: DataFrame, blowout_over: float = 100.0, tight_max: float = 5.0) -> DataFrame:
    """Title margin, its class and the tight-fight flag, with races per season."""
    return seasons.select(
        "year", "wdc_margin_pts", X.margin_class("wdc_margin_pts", blowout_over).alias("margin_class"),
        (F.col("wdc_margin_pts") <= tight_max).alias("is_tight"), "total_races")


def feed_closest_titles(seasons: DataFrame, k: int = 5) -> DataFrame:
    """K9: the k smallest title margins."""
    return seasons.where(F.col("wdc_margin_pts").isNotNull()) \
        .orderBy(F.asc("wdc_margin_pts"), F.asc("year")).limit(k) \
        .select("year", "wdc_driver", "wdc_margin_pts")


def feed_reliability_matrix(teams: DataFrame, from_year: int = 2015, min_seasons: int = 5) -> DataFrame:
    """Mean reliability by team (rows) and season from ``from_year`` on (columns).

    The seasons are the ones in the data (a calendar-sized list); teams with fewer
    than ``min_seasons`` values are dropped. ``place`` is the row's place when sorted
    by the newest season, best first.
    """
    recent = teams.where((F.col("year") >= from_year) & F.col("name").isNotNull())
    years = [r["year"] for r in recent.select("year").distinct().orderBy("year").collect()]
    cols = [f"y{y}" for y in years]
    pv = recent.groupBy("name").pivot("year", years).agg(F.avg("reliability_pct"))
    pv = pv.select("name", *[F.col(str(y)).alias(f"y{y}") for y in years]).na.drop(thresh=min_seasons, subset=cols)
    if not cols:
        return pv.withColumn("place", F.lit(None).cast("long"))
    return placed(pv, [F.desc_nulls_last(cols[-1]), F.asc("name")])


def insights(drivers: DataFrame, teams: DataFrame, seasons: DataFrame, focus_year: int) -> DataFrame:
    """The narrative findings as rows (topic, season, subject, value, detail).

    ``detail`` is the rest of the finding in words: seasons, wins, win rate and podiums of
    the greatest driver, the title margin of the most dominant season, the starts of
    the driver with most wins. One aggregate per mart picks the rows (``max_by`` with
    the id as tie-break); the picked rows are then stacked.
    """
    def best(value: str, *ties: str) -> F.Column:
        return F.struct(F.col(value), *[-F.col(t) for t in ties])

    d = drivers.agg(F.max_by(F.struct(*drivers.columns), best("points_total", "driver_id")).alias("top"),
                    F.max_by(F.struct(*drivers.columns), best("wins", "driver_id")).alias("winner"))
    s = seasons.agg(
        F.max_by(F.struct(*seasons.columns), F.when(F.col("dominance_hhi").isNotNull(), best("dominance_hhi", "year"))).alias("dom"),
        F.max_by(F.struct(*seasons.columns), F.when(F.col("wdc_margin_pts").isNotNull(),
                                                    F.struct(-F.col("wdc_margin_pts"), -F.col("year")))).alias("tight"),
        F.max_by(F.struct(*seasons.columns), F.when(F.col("year") == focus_year, F.col("year"))).alias("focus"),
        F.min("total_races").alias("lo"), F.max("total_races").alias("hi"))
    # Names tie-break ascending: the least name among the best totals.
    t = team_totals(teams).orderBy(F.desc("total_points"), F.asc("name")).limit(1)

    def rows(df: DataFrame, *findings: tuple) -> DataFrame:
        found = [F.struct(F.lit(topic).alias("topic"), season.cast("long").alias("season"),
                          subject.cast("string").alias("subject"), value.cast("double").alias("value"),
                          detail.cast("string").alias("detail"))
                 for topic, season, subject, value, detail in findings]
        return df.select(F.inline(F.array(*found))).where("subject IS NOT NULL OR value IS NOT NULL")

    none, c = F.lit(None), F.col
    return (rows(d, ("greatest_driver", none, c("top.full_name"), c("top.points_total"),
                     F.format_string("%d seasons, %d wins (%s%% of races), %d podiums", "top.seasons_active", "top.wins",
                                     F.col("top.win_rate_pct").cast("decimal(10,4)").cast("string"), "top.podiums")),
                 ("most_race_wins", none, c("winner.full_name"), c("winner.wins"),
                  F.format_string("%d starts", "winner.races_entered")))
            .unionByName(rows(s, ("most_dominant_season", c("dom.year"), c("dom.wdc_driver"), c("dom.dominance_hhi"),
                                  F.concat(F.lit("margin "), c("dom.wdc_margin_pts").cast("decimal(18,1)").cast("string"))),
                              ("closest_title_fight", c("tight.year"), c("tight.wdc_driver"), c("tight.wdc_margin_pts"), none),
                              ("focus_season_hhi", c("focus.year"), c("focus.wdc_driver"), c("focus.dominance_hhi"), none),
                              ("calendar_growth", none, F.format_string("%d to %d races", "lo", "hi"),
                               c("hi") - c("lo"), none)))
            .unionByName(rows(t, ("dominant_constructor", none, c("name"), c("total_points"), none))))


def describe(df: DataFrame, cols: list[str], decimals: int = 2) -> DataFrame:
    """Count, mean, std, min, quartiles (exact, linear), max per column.

    Quartiles come from ``quantiles``, in rounds that split the values by rank, so no task holds or sorts a
    column's values. Results are half-even rounded to ``decimals``.
    """
    long = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x"))
                                        for c in cols]))).where("x IS NOT NULL")
    stats = long.groupBy("column").agg(F.count("x").alias("count"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("std"),
                                       F.min("x").alias("min"), F.max("x").alias("max"))
    quartiles = quantiles(df, cols, [0.25, 0.5, 0.75])
    names = df.sparkSession.createDataFrame([(c, *quartiles[c]) for c in cols],
                                            "column string, q25 double, q50 double, q75 double")
    out = names.join(stats, "column", "left")
    return out.select("column", F.coalesce("count", F.lit(0)).cast("long").alias("count"),
                      *[X.round_half_even(s, decimals).alias(s) for s in ("mean", "std", "min", "q25", "q50", "q75", "max")])

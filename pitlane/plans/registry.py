"""Registered queries: name -> (spark, sf_dir) -> DataFrame over the stand-in tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.operators import clean as C
from pitlane.plans import standin_catalog as cat
from pitlane.sources import ingest as I
from pitlane.sources.contracts import EXPECTED_COLUMNS
from pitlane.sources.standin import STANDIN_ERA

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return deco


def _clean(spark, sf_dir, name):
    return cat.cleaned(spark, sf_dir)[name]


# --- ingestion -------------------------------------------------------------

@register("era_filter_races")
def era_filter_races(spark, sf_dir):
    races = cat.ingested(spark, sf_dir, tag=False)["races"]
    return I.era_races(races, *STANDIN_ERA).select("raceId", "year", "round", "date")


@register("era_semi_join_results")
def era_semi_join_results(spark, sf_dir):
    ing = cat.ingested(spark, sf_dir, tag=False)
    kept = I.era_races(ing["races"], *STANDIN_ERA)
    return I.era_filter_table(ing["results"], "results", kept).select("resultId", "raceId", "driverId", "position", "points")


@register("era_filter_all_tables")
def era_filter_all_tables(spark, sf_dir):
    """P1, P2, J1 over all tables at once: what is left of each, from one set of kept races."""
    kept = I.filter_modern_era(dict(cat.ingested(spark, sf_dir, tag=False)), *STANDIN_ERA)
    return _union([df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows") for n, df in kept.items()])


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@register("ingest_tagged")
def ingest_tagged(spark, sf_dir):
    """Every table tagged; rows per table and source tag, and whether each has an ingest time."""
    tagged = cat.ingested(spark, sf_dir, tag=True)
    return _union([tagged[n].groupBy("_source").agg(
        F.count(F.lit(1)).alias("rows"), F.count("_ingested_at").alias("timed_rows"))
        .select(F.lit(n).alias("table"), F.col("_source").alias("source"), "rows", "timed_rows")
        for n in tagged])


@register("schema_contract")
def schema_contract(spark, sf_dir):
    """Required columns per raw table, how many it has, and its rows."""
    from pitlane.sources.contracts import missing_columns
    r = cat.raw(spark, sf_dir)
    return _union([r[n].agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(n).alias("table"), F.lit(len(cols)).cast("long").alias("required"),
        F.lit(len(missing_columns(r[n], n))).cast("long").alias("missing"), "rows")
        for n, cols in EXPECTED_COLUMNS.items()])


@register("ingest_report")
def ingest_report(spark, sf_dir):
    """S3: every table is checked; one with a missing column is reported and the rest go on.

    Rows are those that were loaded; the results extract here lacks its points.
    """
    r = cat.raw(spark, sf_dir)
    frames = {n: r[n].drop("points") if n == "results" else r[n] for n in r}
    tables, report = I.ingest_frames(frames, validate=True, tag=False)
    status = {name: state for name, state, _ in report}
    return _union([(tables[n] if n in tables else frames[n].where("false")).agg(F.count(F.lit(1)).alias("rows"))
                   .select(F.lit(n).alias("table"), F.lit(status[n]).alias("status"), "rows") for n in frames])


# --- cleaning ----------------------------------------------------------------

for _name in ("results", "drivers", "constructors", "races", "circuits", "driver_standings",
              "constructor_standings", "pit_stops", "lap_times", "status"):
    REGISTRY[f"clean_{_name}"] = (lambda n: (lambda spark, sf_dir: _clean(spark, sf_dir, n)))(_name)

REGISTRY["clean_qualifying_lap_ms"] = lambda spark, sf_dir: _clean(spark, sf_dir, "qualifying")


@register("clean_dispatch_generic")
def clean_dispatch_generic(spark, sf_dir):
    return _clean(spark, sf_dir, "constructor_results")


@register("rename_snake_case")
def rename_snake_case(spark, sf_dir):
    raw = cat.ingested(spark, sf_dir, tag=True)["sprint_results"]
    return C.standardise_column_names(C.drop_metadata_cols(raw)).drop("_seq")


@register("drop_sparse_columns")
def drop_sparse_columns(spark, sf_dir):
    raw = C.standardise_column_names(cat.ingested(spark, sf_dir, tag=False)["races"])
    return C.drop_columns_containing(raw, C.RACE_SPARSE_KEYWORDS).drop("_seq")


def _typed_results(spark, sf_dir):
    raw = C.standardise_column_names(cat.ingested(spark, sf_dir, tag=False)["results"])
    return C.cast_columns(raw, {"result_id": "long"})


@register("dedupe_keep_first")
def dedupe_keep_first(spark, sf_dir):
    """One id in several spellings is one key; the first row in source order stays."""
    return C.remove_duplicates(_typed_results(spark, sf_dir), ["result_id"]).select(
        "result_id", "race_id", "driver_id", "position", "points")


@register("dedupe_report")
def dedupe_report(spark, sf_dir):
    return C.duplicate_report(_typed_results(spark, sf_dir), ["result_id"], "results")


# --- expressions -------------------------------------------------------------

@register("safe_div_pct")
def safe_div_pct(spark, sf_dir):
    """Per-team share of wins in entries, safe when a team has no entries."""
    from pitlane.functions import exprs as X
    r = cat.cleaned_results(spark, sf_dir, ["constructor_id", "position_numeric", "finished", "grid", "race_id"])
    g = r.groupBy("constructor_id").agg(F.count_if(F.col("position_numeric") == 1).alias("wins"),
                                        F.count_if(F.col("finished") == 1).alias("finishes"),
                                        F.count_if((F.col("grid") == 7) & (F.col("race_id") % 100 == 0)).alias("none"))
    return g.select("constructor_id", X.safe_div("wins", "none").alias("per_none"),
                    X.pct("wins", "finishes").alias("win_pct"), X.pct("wins", "finishes", 1).alias("win_pct_1"))


@register("round_half_even")
def round_half_even_q(spark, sf_dir):
    """Half-even and half-away rounding of per-race mean points."""
    from pitlane.functions import exprs as X
    r = cat.cleaned_results(spark, sf_dir, ["race_id", "points"])
    g = r.groupBy("race_id").agg((F.sum("points") / F.lit(8.0)).alias("v"))
    return g.select("race_id", "v", X.round_half_even("v", 2).alias("even_2"), X.round_half_even("v", 0).alias("even_0"),
                    X.round_half_away("v", 2).alias("away_2"), X.round_half_away("v", 0).alias("away_0"))


@register("best_of_three")
def best_of_three(spark, sf_dir):
    """Best of q1/q2/q3 ignoring missing sessions."""
    from pitlane.functions import exprs as X
    q = _clean(spark, sf_dir, "qualifying")
    return q.select("qualify_id", X.best_of("q1_ms", "q2_ms", "q3_ms").alias("best_q_ms"))


# --- SQL layer -----------------------------------------------------------------

def _sql_mart(spark, sf_dir, name):
    return cat.models(spark, sf_dir)[name]


def _staging(spark, sf_dir, view):
    return cat.models(spark, sf_dir)[view]


for _v in ("stg_results", "stg_drivers", "stg_constructors", "stg_races", "stg_circuits",
           "stg_qualifying", "stg_pit_stops"):
    REGISTRY[_v] = (lambda v: (lambda spark, sf_dir: _staging(spark, sf_dir, v)))(_v)

def _csv_staging(spark, sf_dir, view):
    """A staging model in SQL over a CSV file with inferred types."""
    from pitlane.plans.sqlmodels import csv_staging, source_of
    return csv_staging(spark, cat.cleaned_csv(spark, sf_dir, [source_of(view)]), [view])[view]


for _v in ("stg_results", "stg_drivers", "stg_constructors", "stg_races", "stg_circuits",
           "stg_qualifying", "stg_pit_stops"):
    REGISTRY[f"csv_{_v}"] = (lambda v: (lambda spark, sf_dir: _csv_staging(spark, sf_dir, v)))(_v)

for _m, _k in (("mart_driver_performance", "sql_driver_performance"),
               ("mart_team_performance", "sql_team_performance"),
               ("mart_season_overview", "sql_season_overview"),
               ("mart_circuit_stats", "sql_circuit_stats")):
    REGISTRY[_k] = (lambda m: (lambda spark, sf_dir: _sql_mart(spark, sf_dir, m)))(_m)


# --- DataFrame marts -------------------------------------------------------------

def _t(spark, sf_dir):
    return cat.cleaned(spark, sf_dir)


@register("driver_best_season")
def driver_best_season(spark, sf_dir):
    from pitlane.operators import marts as M
    t = _t(spark, sf_dir)
    return M.driver_best_season(M.driver_season_points(t["results"], t["races"]))


@register("driver_avg_qualifying")
def driver_avg_qualifying(spark, sf_dir):
    from pitlane.operators import marts as M
    return M.driver_avg_qualifying(_t(spark, sf_dir)["qualifying"])


@register("driver_avg_pit_stop")
def driver_avg_pit_stop(spark, sf_dir):
    from pitlane.operators import marts as M
    return M.driver_avg_pit_stop(_t(spark, sf_dir)["pit_stops"])


def _marts(spark, sf_dir):
    """The four DataFrame marts over the cleaned tables."""
    return cat.marts(spark, sf_dir)


def _places(mart, value, key):
    """Place of each row by ``value`` (largest first), then ``key``."""
    from pitlane.operators.order import placed
    return placed(mart.select(key, value), [F.desc(value), F.asc(key)])


@register("mart_order_drivers")
def mart_order_drivers(spark, sf_dir):
    """K1."""
    m = cat.stored_marts(spark, sf_dir)["driver_performance_mart"]
    return _places(m.where("driver_id IS NOT NULL"), "points_total", "driver_id")


@register("mart_order_teams")
def mart_order_teams(spark, sf_dir):
    """K2, K4: each season's teams by championship position, and by points."""
    from pitlane.operators.order import placed
    m = cat.stored_marts(spark, sf_dir)["team_performance_mart"]
    m = placed(m.select("constructor_id", "year", "wcc_position", "points_total"),
               [F.asc_nulls_last("wcc_position"), F.asc("constructor_id")], ["year"])
    m = placed(m, [F.desc_nulls_last("points_total"), F.asc("constructor_id")], ["year"], out="place_by_points")
    return m.select("constructor_id", "year", "place", "place_by_points")


@register("mart_order_seasons")
def mart_order_seasons(spark, sf_dir):
    """K3: the seasons of the season mart and of the SQL season overview, in order."""
    from pitlane.operators.order import placed
    marts = {"season_trends_mart": cat.stored_marts(spark, sf_dir)["season_trends_mart"],
             "mart_season_overview": cat.models(spark, sf_dir)["mart_season_overview"]}
    both = _union([df.select(F.lit(n).alias("mart"), F.col("year").cast("long").alias("year"),
                             F.col("total_races").cast("long").alias("total_races")) for n, df in marts.items()])
    return placed(both, [F.asc_nulls_last("year")], ["mart"])


@register("results_order_by_points")
def results_order_by_points(spark, sf_dir):
    """K1 over the whole fact: each entry's place by points; few distinct points, so most of the rows are ties."""
    from pitlane.operators.order import placed
    # Ranges are drawn from a sample first, so their input is read twice: its two columns are written once.
    r = cat.stored(cat.cleaned_results(spark, sf_dir, ["result_id", "points"]), "entry_points")
    return placed(r, [F.desc_nulls_last("points"), F.asc("result_id")])


@register("mart_order_circuits")
def mart_order_circuits(spark, sf_dir):
    """K5."""
    return _places(cat.models(spark, sf_dir)["mart_circuit_stats"], "races_held", "circuit_id")


REGISTRY["driver_performance_mart"] = lambda spark, sf_dir: _marts(spark, sf_dir)["driver_performance_mart"]
REGISTRY["team_performance_mart"] = lambda spark, sf_dir: _marts(spark, sf_dir)["team_performance_mart"]
REGISTRY["season_trends_mart"] = lambda spark, sf_dir: _marts(spark, sf_dir)["season_trends_mart"]
REGISTRY["fact_race_results"] = lambda spark, sf_dir: _marts(spark, sf_dir)["fact_race_results"]


@register("fact_race_results_bucketed")
def fact_race_results_bucketed(spark, sf_dir):
    """M4/J18 over bucketed tables: neither results nor qualifying is shuffled."""
    from pitlane.operators import marts as M
    b = cat.bucketed_entrants(spark, sf_dir)
    return M.build_fact_race_results(b["results"], _t(spark, sf_dir)["races"], b["qualifying"])


@register("season_final_race")
def season_final_race(spark, sf_dir):
    from pitlane.operators import marts as M
    return M.season_final_race(_t(spark, sf_dir)["races"])


@register("season_counts")
def season_counts(spark, sf_dir):
    from pitlane.operators import marts as M
    t = _t(spark, sf_dir)
    return M.season_counts(t["results"], t["races"])


@register("season_hhi")
def season_hhi(spark, sf_dir):
    from pitlane.operators import marts as M
    t = _t(spark, sf_dir)
    return M.season_hhi(t["results"], t["races"])


@register("season_champions")
def season_champions(spark, sf_dir):
    from pitlane.operators import marts as M
    t = _t(spark, sf_dir)
    return M.season_champions(t["driver_standings"], t["constructor_standings"], t["races"],
                              t["drivers"], t["constructors"])


# --- star schema ---------------------------------------------------------------------

def _star(spark, sf_dir):
    from pitlane.operators import star as St
    t = _t(spark, sf_dir)
    return cat.LazyFrames({
        "dim_drivers": lambda: St.build_dimension(t["drivers"], "dim_drivers"),
        "dim_constructors": lambda: St.build_dimension(t["constructors"], "dim_constructors"),
        "dim_circuits": lambda: St.build_dimension(t["circuits"], "dim_circuits"),
        "dim_races": lambda: St.build_dimension(t["races"], "dim_races"),
        "dim_date": lambda: St.build_dim_date(t["races"]),
        "fact_race_results": lambda: St.build_star_fact(t["results"], t["qualifying"]),
    })


for _d in ("dim_drivers", "dim_constructors", "dim_circuits", "dim_races", "dim_date"):
    REGISTRY[_d] = (lambda d: (lambda spark, sf_dir: _star(spark, sf_dir)[d]))(_d)


@register("dim_date_order")
def dim_date_order(spark, sf_dir):
    """The calendar's dates in order."""
    from pitlane.operators.star import calendar
    return calendar(_star(spark, sf_dir)["dim_date"]).select("date", "year", "place")


REGISTRY["star_fact"] = lambda spark, sf_dir: _star(spark, sf_dir)["fact_race_results"]


@register("star_fact_bucketed")
def star_fact_bucketed(spark, sf_dir):
    """D-6/J18 over the same bucketed tables."""
    from pitlane.operators import star as St
    b = cat.bucketed_entrants(spark, sf_dir)
    return St.build_star_fact(b["results"], b["qualifying"])


def _star_written(spark, sf_dir, names=None):
    """S13/D-7: the star schema replaced in a database of its own; (database, row counts)."""
    import uuid

    from pitlane.operators import star as St
    from pitlane.session import scratch_path
    database = f"star_{uuid.uuid4().hex[:10]}"
    star = St.build_star(_t(spark, sf_dir))
    picked = {n: star[n] for n in names or star}
    return database, St.write_star_schema(spark, picked, database, scratch_path(spark, "warehouse"))


@register("star_row_counts")
def star_row_counts(spark, sf_dir):
    """D-7/S13/S14: every star table is written, then counted from what was written."""
    return _star_written(spark, sf_dir)[1]


@register("star_warehouse_roundtrip")
def star_warehouse_roundtrip(spark, sf_dir):
    """A dimension with dates, written twice and read back as a table."""
    from pitlane.operators import star as St
    database, _ = _star_written(spark, sf_dir, ["dim_date"])
    St.write_star_schema(spark, {"dim_date": St.build_dim_date(_t(spark, sf_dir)["races"])}, database)
    return spark.table(f"{database}.dim_date")


@register("sql_mart_table")
def sql_mart_table(spark, sf_dir):
    """The SQL marts saved as tables; the season overview read back."""
    import uuid

    from pitlane.plans.sqlmodels import save_sql_marts
    database = f"models_{uuid.uuid4().hex[:10]}"
    save_sql_marts(spark, cat.models(spark, sf_dir), database)
    return spark.table(f"{database}.mart_season_overview")


# --- feeds ---------------------------------------------------------------------------

# Thresholds for the stand-in data: no stand-in driver reaches 50 or 30 starts
# at small scale, so the feeds use 15 and 12 (the library defaults stay 50/30).
FEED_MIN_50, FEED_MIN_30 = 15, 12
RELIABILITY_FROM = 1997
FOCUS_YEAR = 2000


@register("feed_top15")
def feed_top15(spark, sf_dir):
    from pitlane.operators import feeds as Fd
    return Fd.feed_top_drivers(cat.stored_marts(spark, sf_dir)["driver_performance_mart"], 15)


@register("feed_win_vs_podium")
def feed_win_vs_podium(spark, sf_dir):
    from pitlane.operators import feeds as Fd
    return Fd.feed_win_vs_podium(cat.stored_marts(spark, sf_dir)["driver_performance_mart"], FEED_MIN_50)


@register("feed_hhi_bands")
def feed_hhi_bands(spark, sf_dir):
    from pitlane.operators import feeds as Fd
    return Fd.feed_hhi_bands(cat.stored_marts(spark, sf_dir)["season_trends_mart"])


@register("feed_team_points")
def feed_team_points(spark, sf_dir):
    from pitlane.operators import feeds as Fd
    return Fd.feed_team_points(cat.stored_marts(spark, sf_dir)["team_performance_mart"])


@register("feed_dnf_vs_points")
def feed_dnf_vs_points(spark, sf_dir):
    from pitlane.operators import feeds as Fd
    return Fd.feed_dnf_vs_points(cat.stored_marts(spark, sf_dir)["driver_performance_mart"], FEED_MIN_30)


@register("feed_nationality_top7")
def feed_nationality_top7(spark, sf_dir):
    from pitlane.operators import feeds as Fd
    return Fd.feed_nationality_counts(cat.stored_marts(spark, sf_dir)["driver_performance_mart"], FEED_MIN_30)


@register("feed_wdc_margin")
def feed_wdc_margin(spark, sf_dir):
    from pitlane.operators import feeds as Fd
    return Fd.feed_wdc_margin(cat.stored_marts(spark, sf_dir)["season_trends_mart"])


@register("feed_closest_titles")
def feed_closest_titles(spark, sf_dir):
    from pitlane.operators import feeds as Fd
    return Fd.feed_closest_titles(cat.stored_marts(spark, sf_dir)["season_trends_mart"])


@register("feed_reliability_matrix")
def feed_reliability_matrix(spark, sf_dir):
    from pitlane.operators import feeds as Fd
    return Fd.feed_reliability_matrix(cat.stored_marts(spark, sf_dir)["team_performance_mart"], RELIABILITY_FROM)


@register("insights")
def insights_q(spark, sf_dir):
    from pitlane.operators import feeds as Fd
    m = cat.stored_marts(spark, sf_dir)
    return Fd.insights(m["driver_performance_mart"], m["team_performance_mart"], m["season_trends_mart"],
                       FOCUS_YEAR)


DRIVER_DESCRIBE = ["races_entered", "wins", "podiums", "points_total", "win_rate_pct", "podium_rate_pct",
                   "dnf_rate_pct", "points_per_race", "avg_grid", "avg_finish"]
SEASON_DESCRIBE = ["total_races", "total_drivers", "wdc_points", "dominance_hhi", "wdc_margin_pts"]


@register("describe_drivers")
def describe_drivers(spark, sf_dir):
    from pitlane.operators import feeds as Fd
    return Fd.describe(cat.stored_marts(spark, sf_dir)["driver_performance_mart"], DRIVER_DESCRIBE)


@register("describe_seasons")
def describe_seasons(spark, sf_dir):
    from pitlane.operators import feeds as Fd
    return Fd.describe(cat.stored_marts(spark, sf_dir)["season_trends_mart"], SEASON_DESCRIBE)


# --- data checks -------------------------------------------------------------------

# Columns that are no keys, beside the models' own tests: these do repeat.
REPEATING = [("stg_drivers", "code"), ("stg_pit_stops", "driver_id"), ("mart_team_performance", "constructor_id")]


@register("unique_violations")
def unique_violations(spark, sf_dir):
    from pitlane.operators.quality import UNIQUE_TESTS
    from pitlane.operators.quality import unique_violations as uv
    return uv(cat.store_models(spark, sf_dir), UNIQUE_TESTS + REPEATING)


@register("not_null_violations")
def not_null_violations(spark, sf_dir):
    from pitlane.operators.quality import not_null_violations as nn
    return nn(cat.store_models(spark, sf_dir))


# --- stage outputs and the whole pipeline ------------------------------------------------

@register("fact_partitioned_roundtrip")
def fact_partitioned_roundtrip(spark, sf_dir):
    """Write the fact partitioned by season twice, read it back once."""
    from pitlane.session import scratch_path
    from pitlane.sources.io import write_partitioned_fact
    fact = cat.stored_marts(spark, sf_dir)["fact_race_results"]
    path = scratch_path(spark, "fact_race_results")
    write_partitioned_fact(fact, path)
    write_partitioned_fact(fact, path)  # a re-run replaces seasons, it does not append
    back = spark.read.parquet(path)
    return back.withColumn("year", F.col("year").cast("long"))


@register("fact_one_season")
def fact_one_season(spark, sf_dir):
    """One season of the partitioned fact; no other season's files are read."""
    from pitlane.sources.io import read_seasons
    season = read_seasons(spark, cat.partitioned_fact(spark, sf_dir), [FOCUS_YEAR])
    return season.select("result_id", "race_id", "driver_id", F.col("year").cast("long").alias("year"), "points")


@register("fact_of_dominant_seasons")
def fact_of_dominant_seasons(spark, sf_dir):
    """Entries and points of the seasons that one driver dominated; which they are, the season mart tells at run time."""
    from pitlane.sources.io import read_seasons
    dominated = cat.stored_marts(spark, sf_dir)["season_trends_mart"].where("dominance_hhi >= 0.35")
    fact = read_seasons(spark, cat.partitioned_fact(spark, sf_dir), dominated)
    return fact.groupBy(F.col("year").cast("long").alias("year")).agg(F.count("*").alias("entries"), F.sum("points").alias("points"))


@register("csv_parquet_roundtrip")
def csv_parquet_roundtrip(spark, sf_dir):
    """Marts written as CSV (with dates) and as Parquet; the loader takes each where it is."""
    from pitlane.session import scratch_path
    from pitlane.sources.io import load_mart, write_table
    m = cat.stored_marts(spark, sf_dir)
    team, driver = m["team_performance_mart"], m["driver_performance_mart"]
    base = scratch_path(spark, "marts")
    write_table(team, f"{base}/team_performance_mart.csv", "csv")
    write_table(team.where("false"), f"{base}/driver_performance_mart.csv", "csv")  # Parquet goes first
    write_table(driver, f"{base}/driver_performance_mart.parquet")
    write_table(driver, f"{base}/drivers_as_csv.csv", "csv")
    back = load_mart(spark, base, "team_performance_mart", schema=team.schema)
    parquet = load_mart(spark, base, "driver_performance_mart").select("driver_id", "points_total")
    dated = load_mart(spark, base, "drivers_as_csv", schema=driver.schema).select("driver_id", "dob")
    teams = back.select(F.lit("team").alias("mart"), F.col("constructor_id").alias("id"), "year",
                        F.col("reliability_pct").alias("value"), F.lit(None).cast("date").alias("dob"))
    drivers = parquet.join(dated, "driver_id").select(
        F.lit("driver").alias("mart"), F.col("driver_id").alias("id"), F.lit(None).cast("long").alias("year"),
        F.col("points_total").alias("value"), "dob")
    return teams.unionByName(drivers)


def _pipeline(spark, sf_dir, **options):
    from pitlane.plans.pipeline import run_pipeline
    from pitlane.session import lean_on_disk, scratch_path
    frames = cat.raw(spark, sf_dir)
    out = scratch_path(spark, "outputs")
    with lean_on_disk(spark):
        report = run_pipeline(spark, {n: frames[n] for n in frames}, scratch_path(spark, "processed"), out,
                              start_year=STANDIN_ERA[0], end_year=STANDIN_ERA[1], **options)
    return out, report


@register("pipeline_end_to_end")
def pipeline_end_to_end(spark, sf_dir):
    """Q3: ingest -> era filter (snapshot, S5) -> clean (written) -> marts (written); rows per mart."""
    from pitlane.session import scratch_path
    return _pipeline(spark, sf_dir, era_snapshot_dir=scratch_path(spark, "era"))[1]


@register("pipeline_season_mart")
def pipeline_season_mart(spark, sf_dir):
    """The season mart as the pipeline has written it."""
    from pitlane.sources.io import load_mart
    return load_mart(spark, _pipeline(spark, sf_dir)[0], "season_trends_mart")


@register("incremental_season_load")
def incremental_season_load(spark, sf_dir):
    """E5: a season's results land in two extracts that overlap; two runs merge them into the fact."""
    from pitlane.session import scratch_path
    from pitlane.streaming.incremental import incremental_season_load as load
    fact = cat.one_per_result(spark, sf_dir)
    landing, target, ckpt = (scratch_path(spark, n) for n in ("landing", "fact_stream", "stream_ckpt"))
    fact.where("result_id % 3 < 2").withColumn("points", F.lit(-1.0)).write.mode("append").parquet(landing)
    load(spark, landing, fact.schema, target, ckpt)
    fact.where("result_id % 3 > 0").write.mode("append").parquet(landing)  # corrects one third, adds another
    load(spark, landing, fact.schema, target, ckpt)
    load(spark, landing, fact.schema, target, ckpt)  # nothing new: a no-op run
    back = spark.read.schema(fact.schema).parquet(target)
    return back.select("result_id", "race_id", "driver_id", F.col("year").cast("long").alias("year"), "points")


@register("incremental_season_moves")
def incremental_season_moves(spark, sf_dir):
    """E5: a second extract moves a tenth of the results, and all of the first season, to the next season."""
    from pitlane.session import scratch_path
    from pitlane.streaming.incremental import incremental_season_load as load
    fact = cat.one_per_result(spark, sf_dir)
    landing, target, ckpt = (scratch_path(spark, n) for n in ("landing", "fact_moves", "moves_ckpt"))
    fact.write.mode("append").parquet(landing)
    load(spark, landing, fact.schema, target, ckpt)
    moved = fact.where((F.col("result_id") % 10 == 3) | (F.col("year") == STANDIN_ERA[0]))
    (moved.withColumns({"year": (F.col("year") + 1).cast(fact.schema["year"].dataType), "points": F.lit(-2.0)})
     .write.mode("append").parquet(landing))
    load(spark, landing, fact.schema, target, ckpt)
    back = spark.read.schema(fact.schema).parquet(target)
    return back.select("result_id", "race_id", "driver_id", F.col("year").cast("long").alias("year"), "points")


@register("csv_null_sentinels")
def csv_null_sentinels(spark, sf_dir):
    """Raw drivers written as a header CSV with '\\N' markers, read back as text.

    The reader takes every column as text (no inference) and maps the
    sentinels to NULL before the contract check.
    """
    from pitlane.session import scratch_path
    from pitlane.sources.ingest import load_raw_table
    raw_dir = scratch_path(spark, "raw")
    drivers = cat.raw(spark, sf_dir)["drivers"].drop("_seq")
    drivers.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{raw_dir}/drivers.csv")
    back = load_raw_table(spark, "drivers", raw_dir, validate=True, tag=False)
    return back.drop("_seq")


def _damaged_extract(spark, sf_dir):
    """Raw CSV extracts of all tables in which a sixteenth of the records each is too long, too short, has
    an open quote, or a well-formed quoted field; which, follows from the record's md5."""
    from pitlane.session import scratch_path
    raw_dir = scratch_path(spark, "damaged")
    tables = cat.raw(spark, sf_dir)
    for name, cols in EXPECTED_COLUMNS.items():
        texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]
        record, short = F.concat_ws(",", *texts), F.concat_ws(",", *texts[:-1])
        quoted = F.concat(F.col("short"), F.lit(',"'), F.col("last"), F.lit(', ""so""\"'))
        # Each text is made once per row, its digest too: conditions share no work.
        parts = tables[name].select(record.alias("record"), short.alias("short"), texts[-1].alias("last"))
        parts = parts.select("*", F.left(F.md5("record"), F.lit(1)).alias("digit"))
        digit, record, short = F.col("digit"), F.col("record"), F.col("short")
        line = (F.when(digit == "0", F.concat(record, F.lit(",surplus"))).when(digit == "1", short)
                .when(digit == "2", F.concat(F.lit('"'), record)).when(digit == "3", quoted).otherwise(record))
        (parts.select(line.alias(",".join(cols))).write.option("header", True).option("quote", "")
         .option("sep", "\u0001").option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(f"{raw_dir}/{name}.csv"))
    return raw_dir


@register("csv_malformed_rows")
def csv_malformed_rows(spark, sf_dir):
    """What is loaded of each damaged extract (rows, characters) and what the quarantine lists by kind."""
    raw_dir = _damaged_extract(spark, sf_dir)
    loaded = []
    for name, cols in EXPECTED_COLUMNS.items():
        df = I.load_raw_table(spark, name, raw_dir, tag=False)
        length = F.length(F.concat_ws("", *[F.col(c) for c in cols]))
        loaded.append(df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(length), F.lit(0)).alias("characters"))
                      .select(F.lit(name).alias("table"), F.lit("loaded").alias("kind"), "rows", "characters"))
    listed = (I.quarantine(spark, raw_dir).groupBy("table", "kind")
              .agg(F.count("*").alias("rows"), F.sum(F.length("record")).alias("characters")))
    return _union([*loaded, listed])

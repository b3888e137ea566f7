"""Stand-in warehouse: raw -> ingested -> era-filtered -> cleaned -> marts.

Each stage is a lazy mapping: a table is built on first access only. The raw result
lines, the cleaned tables and the marts are written to the session's shared folder
when first used and read from there afterwards, as the pipeline's stages hand over
written tables; what was written is remembered per application and input folder.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from pitlane.operators import marts as M
from pitlane.operators.clean import CLEANERS, clean_generic
from pitlane.plans.sqlmodels import SQL_MARTS, STAGING_COLUMNS, sql_mart, staging
from pitlane.session import compilable_code, scratch_path
from pitlane.sources import standin as S
from pitlane.sources.contracts import EXPECTED_COLUMNS, RACE_LINKED
from pitlane.sources.ingest import KeptRaces, era_filter_table, era_races, prepare_raw
from pitlane.sources.io import store_bucketed, write_partitioned_fact, write_table


class LazyFrames(Mapping):
    """Mapping of table name -> DataFrame whose plans are built on first access."""

    def __init__(self, factories: dict[str, Callable[[], DataFrame]]):
        self._factories = factories
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._factories[name]()
        return self._built[name]

    def built(self, name: str) -> bool:
        """Whether the table is there already."""
        return name in self._built

    def __iter__(self) -> Iterator[str]:
        return iter(self._factories)

    def __len__(self) -> int:
        return len(self._factories)


_MEMO: dict[tuple, Mapping] = {}


def _memo(spark: SparkSession, key: tuple, build: Callable[[], Mapping]) -> Mapping:
    """Frames of this application; those of an earlier, stopped one are forgotten."""
    app = spark.sparkContext.applicationId
    for old in [k for k in _MEMO if k[0] != app]:
        del _MEMO[old]
    if (app, *key) not in _MEMO:
        _MEMO[(app, *key)] = build()
    return _MEMO[(app, *key)]


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the frame to the shared folder and read it back."""
    spark = df.sparkSession
    path = write_table(df, scratch_path(spark, name))
    return spark.read.schema(df.schema).parquet(path)


def result_lines(spark: SparkSession, sf_dir: str) -> LazyFrames:
    """The raw result lines, written when first used. Their ``_seq`` repeats columns, so it is made anew on each read."""
    def build():
        t = S.read_tables(spark, sf_dir, S.SOURCE_TABLES)
        once = LazyFrames({"unwritten": lambda: S.result_lines(t),
                           "lines": lambda: S.with_seq(stored(once["unwritten"].drop("_seq"), "result_lines"))})
        return once
    return _memo(spark, ("lines", sf_dir), build)


def raw(spark: SparkSession, sf_dir: str) -> LazyFrames:
    compilable_code(spark)

    def build():
        t = S.read_tables(spark, sf_dir, S.SOURCE_TABLES)
        L = lambda: result_lines(spark, sf_dir)["lines"]
        return LazyFrames({
            "results": lambda: S.results_raw(L()),
            "drivers": lambda: S.drivers_raw(t),
            "constructors": lambda: S.constructors_raw(t),
            "races": lambda: S.races_raw(t),
            "circuits": lambda: S.circuits_raw(t),
            "driver_standings": lambda: S.driver_standings_raw(t, L()),
            "constructor_standings": lambda: S.constructor_standings_raw(t, L()),
            "qualifying": lambda: S.qualifying_raw(L()),
            "pit_stops": lambda: S.pit_stops_raw(t),
            "lap_times": lambda: S.lap_times_raw(t),
            "status": lambda: S.status_raw(t),
            "constructor_results": lambda: S.constructor_results_raw(L()),
            "sprint_results": lambda: S.sprint_results_raw(L()),
            "seasons": lambda: S.seasons_raw(t),
        })
    return _memo(spark, ("raw", sf_dir), build)


def ingested(spark: SparkSession, sf_dir: str, tag: bool = True) -> LazyFrames:
    """Raw stand-ins after sentinel handling, contract check and tagging."""
    r = raw(spark, sf_dir)
    return _memo(spark, ("ingested", sf_dir, tag), lambda: LazyFrames(
        {n: (lambda n=n: prepare_raw(r[n], n, validate=True, tag=tag)) for n in EXPECTED_COLUMNS}))


def kept_races(spark: SparkSession, sf_dir: str, era: tuple[int, int]) -> LazyFrames:
    """The era's races and the set of their ids, which is written when first used."""
    def build():
        ing = ingested(spark, sf_dir)
        once = LazyFrames({"races": lambda: era_races(ing["races"], *era), "kept": lambda: KeptRaces(once["races"])})
        return once
    return _memo(spark, ("kept", sf_dir, era), build)


def era_filtered(spark: SparkSession, sf_dir: str, era: tuple[int, int] = S.STANDIN_ERA) -> LazyFrames:
    ing, once = ingested(spark, sf_dir), kept_races(spark, sf_dir, era)
    return _memo(spark, ("era", sf_dir, era), lambda: LazyFrames(
        {n: (lambda n=n: era_filter_table(ing[n], n, once["races"], once["kept"] if n in RACE_LINKED else None))
         for n in EXPECTED_COLUMNS}))


def cleaned(spark: SparkSession, sf_dir: str, era: tuple[int, int] = S.STANDIN_ERA) -> LazyFrames:
    """The cleaned tables (written once) that every mart, model and feed is built from."""
    e = era_filtered(spark, sf_dir, era)
    return _memo(spark, ("clean", sf_dir, era), lambda: LazyFrames(
        {n: (lambda n=n: stored(CLEANERS.get(n, clean_generic)(e[n]), f"{n}_clean")) for n in EXPECTED_COLUMNS}))


def cleaned_results(spark: SparkSession, sf_dir: str, columns: list[str],
                    era: tuple[int, int] = S.STANDIN_ERA) -> DataFrame:
    """These columns of the cleaned results, for a query that needs no others.

    They come from the written table if this session has it. Else the same steps run over all rows as one plan, in which
    Spark leaves out what only the other columns need: their casts, their share of the shuffles and of two written tables.
    """
    whole = cleaned(spark, sf_dir, era)
    if whole.built("results"):
        return whole["results"].select(*columns)
    races, lines = kept_races(spark, sf_dir, era), result_lines(spark, sf_dir)
    entries = prepare_raw(S.results_raw(lines["lines" if lines.built("lines") else "unwritten"]), "results")
    entries = era_filter_table(entries, "results", races["races"], races["kept"])
    return CLEANERS["results"](entries).select(*columns)


def store_cleaned(spark: SparkSession, sf_dir: str, names: list[str]) -> None:
    """Write the named cleaned tables now, a few at a time."""
    era_filtered(spark, sf_dir)["results"]  # the lines and the kept races that several tables share come first
    frames = cleaned(spark, sf_dir)
    with ThreadPoolExecutor(max_workers=8) as pool:
        list(pool.map(frames.__getitem__, names))


def marts(spark: SparkSession, sf_dir: str) -> LazyFrames:
    """The DataFrame marts over the cleaned tables (lazy plans)."""
    t = cleaned(spark, sf_dir)
    return _memo(spark, ("marts", sf_dir), lambda: LazyFrames({
        "driver_performance_mart": lambda: M.build_driver_performance_mart(
            t["results"], t["drivers"], t["races"], t["qualifying"], t["pit_stops"], min_races=5),
        "team_performance_mart": lambda: M.build_team_performance_mart(
            t["results"], t["constructor_standings"], t["constructors"], t["races"]),
        "season_trends_mart": lambda: M.build_season_trends_mart(
            t["results"], t["driver_standings"], t["races"], t["drivers"], t["constructors"],
            t["constructor_standings"]),
        "fact_race_results": lambda: M.build_fact_race_results(t["results"], t["races"], t["qualifying"]),
    }))


def stored_marts(spark: SparkSession, sf_dir: str) -> LazyFrames:
    """The same marts, written once: what feeds, insights and checks read."""
    m = marts(spark, sf_dir)
    return _memo(spark, ("stored_marts", sf_dir), lambda: LazyFrames({n: (lambda n=n: stored(m[n], n)) for n in m}))


def models(spark: SparkSession, sf_dir: str, keep: bool = False) -> LazyFrames:
    """Staging models and SQL marts by name; with ``keep`` the marts are written once."""
    t = cleaned(spark, sf_dir)

    def build():
        frames = {v: (lambda v=v: staging(t, [v])[v]) for v in STAGING_COLUMNS}
        out = LazyFrames(frames)
        hold = (lambda df, n: stored(df, n)) if keep else (lambda df, n: df)
        frames |= {n: (lambda n=n: hold(sql_mart(spark, n, out), n)) for n in SQL_MARTS}
        return out
    return _memo(spark, ("models", sf_dir, keep), build)


def cleaned_csv(spark: SparkSession, sf_dir: str, names: list[str]) -> str:
    """A folder with the named cleaned tables as ``{name}_clean.csv``, each written once."""
    folder = _memo(spark, ("csv", sf_dir), lambda: {"folder": scratch_path(spark, "cleaned_csv")})
    for n in names:
        if n not in folder:
            folder[n] = write_table(cleaned(spark, sf_dir)[n], f"{folder['folder']}/{n}_clean.csv", "csv")
    return folder["folder"]


def partitioned_fact(spark: SparkSession, sf_dir: str) -> str:
    """The path of the wide fact partitioned by season, written once, and only in this form."""
    return _memo(spark, ("partitioned_fact", sf_dir), lambda: {"path": write_partitioned_fact(
        marts(spark, sf_dir)["fact_race_results"], scratch_path(spark, "fact_by_season"))})["path"]


def one_per_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide fact with one row per result id, picked and written once: every reader sees the same rows."""
    return _memo(spark, ("one_per_result", sf_dir), lambda: {"fact": stored(
        marts(spark, sf_dir)["fact_race_results"].dropDuplicates(["result_id"]), "one_per_result")})["fact"]


#: Least number of buckets of the entrants' tables, and the rows that one bucket of the larger one should hold.
BUCKETS, BUCKET_ROWS = 8, 1_000_000


def buckets_for(*tables: DataFrame) -> int:
    """Buckets that keep a bucket's size bounded however large the tables are (their Parquet footers tell the rows)."""
    return max(BUCKETS, -(-max(df.count() for df in tables) // BUCKET_ROWS))


def bucketed_entrants(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    """Results and qualifying stored in buckets of (race_id, driver_id), each written once."""
    t = cleaned(spark, sf_dir)
    once = LazyFrames({"buckets": lambda: buckets_for(t["results"], t["qualifying"])})

    def stored_as(name: str) -> DataFrame:
        table = f"{name}_by_entrant_{uuid.uuid4().hex[:8]}"
        return store_bucketed(t[name], table, ["race_id", "driver_id"], once["buckets"], scratch_path(spark, table))

    return _memo(spark, ("bucketed", sf_dir), lambda: LazyFrames(
        {n: (lambda n=n: stored_as(n)) for n in ("results", "qualifying")}))


def store_models(spark: SparkSession, sf_dir: str) -> LazyFrames:
    """The models with their marts written, those that aren't yet a few at a time."""
    frames = models(spark, sf_dir, keep=True)
    with ThreadPoolExecutor(max_workers=4) as pool:
        list(pool.map(frames.__getitem__, SQL_MARTS))
    return frames

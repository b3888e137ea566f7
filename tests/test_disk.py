"""The pipeline holds little on disk: shuffle files go with their write, rows travel without what others repeat."""

import time

from pyspark.sql import functions as F

from pitlane.operators.marts import build_fact_race_results
from pitlane.plans.pipeline import run_pipeline
from pitlane.session import lean_on_disk
from pitlane.sources import standin as S
from pitlane.sources.contracts import EXPECTED_COLUMNS
from pitlane.sources.io import write_table

CODEC = "spark.sql.parquet.compression.codec"


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def left_over(spark, before):
    """Shuffle files that are there beside ``before``; Spark removes them in the background."""
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    return shuffle_files(spark) - before


def raw_tables(spark):
    """All raw tables: twelve results (one of them twice) and two qualifying entries of one driver in three races."""
    known = {
        "races": [{"raceId": str(r), "year": str(1999 + r), "round": "1", "name": f"Race {r}"} for r in range(1, 4)],
        "results": [{"resultId": str(10 * r + d), "raceId": str(r), "driverId": str(d), "constructorId": "1", "grid": "1",
                     "position": str(d), "points": str(9 - d)} for r in range(1, 4) for d in (1, 1, 2, 3, 4)],
        "qualifying": [{"qualifyId": str(r + 10 * k), "raceId": str(r), "driverId": "2", "position": str(k)}
                       for r in range(1, 4) for k in range(2)],
    }
    out = {}
    for name, columns in EXPECTED_COLUMNS.items():
        rows = [[row.get(c, S.NULL) for c in columns] for row in known.get(name, [{columns[0]: "1"}])]
        out[name] = spark.createDataFrame([(*row, i) for i, row in enumerate(rows)],
                                          ", ".join(f"{c} string" for c in columns) + ", _seq long")
    return out


def test_the_pipeline_leaves_no_shuffle_files(spark, tmp_path):
    before, session = shuffle_files(spark), spark.conf.get(CODEC)
    report = run_pipeline(spark, raw_tables(spark), f"{tmp_path}/clean", f"{tmp_path}/out", min_races=1,
                          era_snapshot_dir=f"{tmp_path}/era")
    assert {r.table: r.rows for r in report.collect()} == {
        "driver_performance_mart": 4, "team_performance_mart": 3, "season_trends_mart": 3, "fact_race_results": 15}
    assert not left_over(spark, before)
    assert list(tmp_path.glob("era/results_era/*.zstd.parquet")) and list(tmp_path.glob("out/fact*/year=2000/*.zstd.parquet"))
    assert spark.read.parquet(f"{tmp_path}/era/results_era").count() == 15
    assert spark.conf.get(CODEC) == session  # the session's settings are back


def test_a_sessions_own_settings_stay(spark, tmp_path):
    spark.conf.set(CODEC, "gzip")
    try:
        with lean_on_disk(spark):
            write_table(spark.range(3).toDF("id"), f"{tmp_path}/t")
        assert spark.conf.get(CODEC) == "gzip" and list(tmp_path.glob("t/*.gz.parquet"))
    finally:
        spark.conf.unset(CODEC)


def test_the_fact_is_shuffled_without_the_calendars_columns(spark):
    results = spark.createDataFrame([(1, 1, 7), (2, 2, 7), (3, None, 7), (4, 9, None)],
                                    "result_id long, race_id long, driver_id long").withColumns(
        {"grid": F.lit(1), "position_numeric": F.lit(1.0)})
    races = spark.createDataFrame([(1, 2000, "A"), (2, 2001, "B")], "race_id long, year long, name string")
    qualifying = spark.createDataFrame([(1, 7, 3), (1, 7, 4), (9, 8, 5)], "race_id long, driver_id long, position long")
    fact = build_fact_race_results(results, races, qualifying)
    rows = fact.select("result_id", "year", "name", "qualifying_position").collect()
    assert sorted(map(tuple, rows), key=repr) == [
        (1, 2000, "A", 3), (1, 2000, "A", 4), (2, 2001, "B", None), (3, None, None, None), (4, None, None, None)]
    joins = [x for x in fact._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in x]
    assert len(joins) == 2 and "driver_id" not in joins[0] and "driver_id" in joins[1]


def test_a_qualifying_entry_carries_its_columns_once(spark):
    entries = [(12, 1, 5, 2, 1, 31, 9, 20.0, "N", "F"), (11, 1, 5, 3, 2, 30, 8, 7.0, "N", "O"), (11, 1, 5, 3, 2, 30, 8, 6.0, "N", "O")]
    lines = spark.createDataFrame(entries, """result_id long, race_id long, driver_id long, constructor_id long, grid long,
        l_partkey long, l_suppkey long, l_quantity double, l_returnflag string, l_linestatus string""")
    lines = S.with_seq(lines.withColumn("qty", F.col("l_quantity").cast("long")))
    out = S.qualifying_raw(lines)
    assert [tuple(r)[:-1] for r in out.collect()] == [("22", "1", "5", "3", "5", "11", "2:11.030", "2:11.030", "2:11.030")]
    least = [x for x in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "min(struct(" in x.lower()]
    assert least and not any("qty" in x for x in least)

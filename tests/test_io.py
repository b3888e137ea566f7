import uuid

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from pitlane.operators.star import write_star_schema
from pitlane.sources.io import counting, read_seasons, remove_partition, replace_table, rows_seen, write_partitioned_fact, write_table
from pitlane.streaming.incremental import incremental_season_load, upsert_seasons

SCHEMA = "result_id long, points double, year long"


def plan_of(df):
    return df._jdf.queryExecution().toString()


@pytest.fixture
def fact(spark, tmp_path):
    df = spark.range(4000).select(F.col("id").alias("result_id"), (F.col("id") % 7).cast("double").alias("points"),
                                  (2000 + F.col("id") % 8).alias("year"))
    return write_partitioned_fact(df, str(tmp_path / "fact"))


def files_read(df):
    return {f.rsplit("year=", 1)[1].split("/")[0] for f in df.select(F.input_file_name()).distinct().toPandas().iloc[:, 0]}


def test_one_season_reads_its_partition_only(spark, fact):
    df = read_seasons(spark, fact, [2003])
    assert df.count() == 500 and files_read(df) == {"2003"}
    scan = plan_of(df).split("== Physical Plan ==")[1]
    assert "PartitionFilters: [isnotnull(year" in scan or "PartitionFilters: [(year" in scan or "PartitionFilters: [year" in scan
    assert read_seasons(spark, fact, []).count() == 0


def test_seasons_of_a_frame_prune_at_run_time(spark, fact):
    seasons = spark.range(2000, 2008).select(F.col("id").alias("year"), (F.col("id") % 4).alias("band"))
    path = fact + "-seasons"
    seasons.write.parquet(path)
    df = read_seasons(spark, fact, spark.read.parquet(path).where("band = 1"))
    assert "dynamicpruning" in plan_of(df)
    assert sorted(r.year for r in df.select("year").distinct().collect()) == [2001, 2005]
    assert df.count() == 1000


def test_a_moved_result_leaves_its_old_season(spark, tmp_path):
    landing, target, ckpt = (str(tmp_path / n) for n in ("landing", "fact", "ckpt"))

    def land(rows):
        spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(landing)
        incremental_season_load(spark, landing, spark.createDataFrame([], SCHEMA).schema, target, ckpt)
        return sorted((r.result_id or -1, r.points, r.year) for r in spark.read.schema(SCHEMA).parquet(target).collect())

    land([(1, 1.0, 2000), (2, 2.0, 2000), (3, 3.0, 2001), (4, 4.0, 2002), (5, 5.0, None)])
    assert land([(1, 9.0, 2001)]) == [(1, 9.0, 2001), (2, 2.0, 2000), (3, 3.0, 2001), (4, 4.0, 2002), (5, 5.0, None)]
    assert land([(4, 8.0, 2003)])[3] == (4, 8.0, 2003)  # the only row of 2002: the season is gone
    assert not (tmp_path / "fact" / "year=2002").exists()
    assert land([(5, 6.0, 2000), (2, 2.5, None)]) == [(1, 9.0, 2001), (2, 2.5, None), (3, 3.0, 2001), (4, 8.0, 2003), (5, 6.0, 2000)]
    assert land([(None, 1.0, 2001), (None, 2.0, 2001), (None, 1.0, 2001)])[:2] == [(-1, 1.0, 2001), (-1, 2.0, 2001)]


def test_a_batch_that_comes_again_changes_nothing(spark, tmp_path):
    target = str(tmp_path / "fact")
    upsert_seasons(spark.createDataFrame([(1, 1.0, 2000), (2, 2.0, 2000)], SCHEMA), target)
    batch = spark.createDataFrame([(1, 3.0, 2001), (2, 3.0, 2001)], SCHEMA)
    # As if the run had died before the emptied season was removed:
    write_partitioned_fact(batch, target)
    for _ in range(2):
        upsert_seasons(batch, target)
        assert sorted(map(tuple, spark.read.schema(SCHEMA).parquet(target).collect())) == [(1, 3.0, 2001), (2, 3.0, 2001)]
    remove_partition(spark, target, "year", 1950)  # none such


@pytest.fixture
def database(spark, tmp_path):
    name = f"io_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path / 'db'}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_a_failed_write_leaves_the_old_table(spark, database, tmp_path):
    root, table = str(tmp_path / "db"), f"{database}.t"
    assert replace_table(spark.range(10).toDF("a"), table, root) == 10
    broken = spark.range(10).select(F.when(F.col("id") > 5, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("a"))
    with pytest.raises(Exception, match="lost"):
        replace_table(broken, table, root)
    assert spark.table(table).count() == 10


def test_a_reader_keeps_the_table_it_began_with(spark, database, tmp_path):
    root, table = str(tmp_path / "db"), f"{database}.t"
    replace_table(spark.range(10).toDF("a"), table, root)
    reader = spark.table(table)
    replace_table(spark.range(20).toDF("a"), table, root)
    assert reader.count() == 10 and spark.table(table).count() == 20
    for n in (30, 40):
        replace_table(spark.range(n).toDF("a"), table, root)
    assert spark.table(table).count() == 40
    assert len(list((tmp_path / "db" / "t").glob("v-*"))) == 2  # this version and the one before
    replace_table(spark.createDataFrame([("x", 1)], "b string, c int"), table, root)  # other columns
    assert [tuple(r) for r in spark.table(table).collect()] == [("x", 1)]
    assert replace_table(spark.createDataFrame([], "b string, c int"), table, root) == 0
    assert spark.table(table).columns == ["b", "c"] and spark.table(table).count() == 0


def test_rows_are_counted_by_the_write_itself(spark, database, tmp_path):
    df = spark.range(1000).repartition(5).where("id % 3 = 0")
    tracker = spark.sparkContext.statusTracker()

    def jobs(group, run):
        spark.sparkContext.setJobGroup(group, group)
        try:
            return run(), len(tracker.getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)

    seen = Observation()
    _, plain = jobs("plain-write", lambda: write_table(df, str(tmp_path / "a")))
    _, counted = jobs("counted-write", lambda: write_table(df, str(tmp_path / "b"), seen=seen))
    assert rows_seen(seen) == 334 and counted == plain
    by_season = Observation()
    write_partitioned_fact(df.withColumn("year", F.col("id") % 4), str(tmp_path / "c"), seen=by_season)
    assert rows_seen(by_season) == 334 == spark.read.parquet(str(tmp_path / "c")).count()
    assert counting(df, None) is df
    report = write_star_schema(spark, {"x": df, "y": df.where("false")}, database)
    assert sorted(map(tuple, report.collect())) == [("x", 334), ("y", 0)]
    assert spark.table(f"{database}.x").count() == 334

from pyspark.sql import functions as F

from pitlane.sources.io import write_partitioned_fact


def test_partitioned_write_is_idempotent(spark, tmp_path):
    df = spark.createDataFrame([(1, 2000), (2, 2001)], "result_id long, year long")
    path = str(tmp_path / "fact")
    write_partitioned_fact(df, path)
    write_partitioned_fact(df, path)
    assert spark.read.parquet(path).count() == 2
    # reloading one season leaves the other alone
    write_partitioned_fact(spark.createDataFrame([(3, 2001)], "result_id long, year long"), path)
    back = {r.result_id: r.year for r in spark.read.parquet(path).collect()}
    assert back == {1: 2000, 3: 2001}


def test_skewed_season_is_split(spark, tmp_path):
    """With a small advisory size a season is written by several tasks."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        df = spark.range(200_000).selectExpr("id AS result_id", "uuid() AS payload", "2000L AS year")
        write_partitioned_fact(df, str(tmp_path / "fact"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "fact" / "year=2000").glob("part-*"))) > 1


def test_incremental_load_keeps_earlier_extracts(spark, tmp_path):
    from pitlane.streaming.incremental import incremental_season_load
    landing, target, ckpt = (str(tmp_path / n) for n in ("landing", "fact", "ckpt"))
    schema = "result_id long, points double, year long"

    def land(rows):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(landing)
        incremental_season_load(spark, landing, spark.createDataFrame([], schema).schema, target, ckpt)

    land([(1, 1.0, 2000), (2, 2.0, 2000), (3, 3.0, 2000), (9, 9.0, 2001)])
    land([(3, 30.0, 2000), (4, 4.0, 2000)])  # a second extract of one season corrects a row
    back = {r.result_id: (r.points, r.year) for r in spark.read.parquet(target).collect()}
    assert back == {1: (1.0, 2000), 2: (2.0, 2000), 3: (30.0, 2000), 4: (4.0, 2000), 9: (9.0, 2001)}


def test_loaders(spark, tmp_path):
    import datetime

    import pytest

    from pitlane.session import path_exists
    from pitlane.sources.io import load_mart, read_table, write_table
    df = spark.createDataFrame([(1, datetime.date(1985, 1, 7))], "id long, dob date")
    write_table(df, f"{tmp_path}/m.csv", "csv")
    assert load_mart(spark, str(tmp_path), "m", schema=df.schema).collect() == df.collect()
    write_table(df.where("false"), f"{tmp_path}/m.parquet")
    assert load_mart(spark, str(tmp_path), "m").count() == 0  # Parquet goes first
    assert path_exists(spark, f"file:{tmp_path}/m.csv") and not path_exists(spark, f"{tmp_path}/none")
    with pytest.raises(FileNotFoundError):
        load_mart(spark, str(tmp_path), "none")
    with pytest.raises(FileNotFoundError):
        read_table(spark, f"{tmp_path}/none")


def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert "total_races" in df.columns

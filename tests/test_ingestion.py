import pytest
from pyspark.sql import functions as F

from pitlane.sources.contracts import SchemaContractError, validate_schema
from pitlane.sources.ingest import filter_modern_era, load_raw_table, prepare_raw, tag_metadata


def test_contract_missing_column_raises(spark):
    df = spark.createDataFrame([("1",)], "statusId string")
    with pytest.raises(SchemaContractError, match="lacks required columns: status"):
        validate_schema(df, "status")


def test_contract_extra_columns_allowed(spark):
    df = spark.createDataFrame([("1", "Finished", "x")], "statusId string, status string, extra string")
    assert validate_schema(df, "status") is df


def test_contract_unknown_table_passes(spark):
    df = spark.createDataFrame([("1",)], "a string")
    assert validate_schema(df, "not_a_table") is df


def test_tagging_adds_source_and_time(spark):
    df = tag_metadata(spark.createDataFrame([("1", "ok")], "statusId string, status string"), "status")
    row = df.collect()[0]
    assert row["_source"] == "status" and row["_ingested_at"] is not None


@pytest.fixture
def era_tables(spark):
    races = spark.createDataFrame([(str(i), str(y), "1") for i, y in
                                   [(1, 1995), (2, 2000), (3, 2010), (4, 2020), (5, 2025)]],
                                  "raceId string, year string, round string")
    results = spark.createDataFrame([(str(i), str(10 + i)) for i in range(1, 6)], "raceId string, driverId string")
    drivers = spark.createDataFrame([(str(10 + i), f"D{i}") for i in range(1, 6)], "driverId string, name string")
    return {"races": races, "results": results, "drivers": drivers}


def test_era_filter_keeps_inclusive_range(era_tables):
    out = filter_modern_era(era_tables, 2000, 2024)
    assert sorted(r.year for r in out["races"].collect()) == ["2000", "2010", "2020"]
    assert out["results"].count() == 3
    assert out["drivers"].count() == 5


def test_era_filter_requires_races(era_tables):
    with pytest.raises(KeyError):
        filter_modern_era({"results": era_tables["results"]})


def test_csv_reader_sentinels_and_quotes(spark, tmp_path):
    (tmp_path / "status.csv").write_text(
        'statusId,status\n1,"Finished, ""clean"""\n2,\\N\n3,NULL\n4,NA\n5,\n6,+1 Lap\n')
    df = load_raw_table(spark, "status", str(tmp_path))
    rows = {r.statusId: r.status for r in df.collect()}
    assert rows["1"] == 'Finished, "clean"'
    assert rows["2"] is None and rows["3"] is None and rows["4"] is None and rows["5"] is None
    assert rows["6"] == "+1 Lap"
    assert "_seq" in df.columns and "_source" in df.columns


def test_csv_reader_keeps_file_order_and_quoted_newlines(spark, tmp_path):
    from pitlane.operators.clean import clean_status
    from pitlane.sources.ingest import read_raw_csv
    folder = tmp_path / "status.csv"
    folder.mkdir()
    for n, text in (("a", "7,first"), ("b", "007,second"), ("c", "7.0,third")):
        (folder / f"{n}.csv").write_text(f"statusId,status\n{text}\n")
    out = clean_status(read_raw_csv(spark, str(folder))).collect()
    assert [(r.status_id, r.status) for r in out] == [(7, "first")]
    (tmp_path / "q.csv").write_text('statusId,status\n1,"two\nlines"\n')
    assert read_raw_csv(spark, str(tmp_path / "q.csv"), quoted_newlines=True).first().status == "two\nlines"


def test_missing_file_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        load_raw_table(spark, "results", str(tmp_path))


def test_prepare_raw_nulls_sentinels(spark):
    df = prepare_raw(spark.createDataFrame([("1", "\\N")], "statusId string, status string"), "status", tag=False)
    assert df.where(F.col("status").isNull()).count() == 1

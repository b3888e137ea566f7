import pytest
from pyspark.sql import functions as F

from pitlane.operators import quality
from pitlane.operators.quality import unique_violations
from pitlane.sources.ingest import filter_modern_era
from pitlane.sources.io import store_bucketed


@pytest.fixture(scope="module")
def models(spark):
    a = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 10).alias("few"),
                                 F.when(F.col("id") > 4, F.col("id")).alias("gaps"), F.when(F.col("id") % 500 == 7, F.lit("twice"))
                                 .otherwise(F.col("id").cast("string")).alias("one_pair")).repartition(3)
    return {"a": a, "b": spark.createDataFrame([], "k long")}


def run(models, tests):
    return {(r.model, r.column): (r.duplicate_keys, r.duplicate_rows) for r in unique_violations(models, tests).collect()}


def test_repeats_are_counted_exactly(models):
    tests = [("a", "k"), ("a", "few"), ("a", "gaps"), ("a", "one_pair"), ("b", "k")]
    assert run(models, tests) == {("a", "k"): (0, 0), ("a", "few"): (10, 1000), ("a", "gaps"): (0, 0),
                                  ("a", "one_pair"): (1, 2), ("b", "k"): (0, 0)}
    assert run(models, tests[:1]) == {("a", "k"): (0, 0)}


def test_colliding_hashes_are_no_repeats(models, monkeypatch):
    monkeypatch.setattr(quality.F, "xxhash64", lambda c: F.crc32(F.col(c).cast("binary")) % 7)
    assert run(models, [("a", "k"), ("a", "one_pair")]) == {("a", "k"): (0, 0), ("a", "one_pair"): (1, 2)}


def test_bucketed_entrants_join_without_a_shuffle(spark, tmp_path):
    from pitlane.operators.marts import qualifying_positions
    results = spark.range(3000).select((F.col("id") % 97).alias("race_id"), (F.col("id") % 89).alias("driver_id"), F.col("id").alias("result_id"))
    qualifying = results.where("result_id % 3 = 0").select("race_id", "driver_id", (F.col("result_id") % 20).alias("position"))
    tables = [store_bucketed(df, f"{n}_bucket_test", ["race_id", "driver_id"], 4, str(tmp_path / n))
              for n, df in (("results", results), ("qualifying", qualifying))]
    joined = tables[0].join(qualifying_positions(tables[1]).hint("merge"), ["race_id", "driver_id"], "left")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    want = results.join(qualifying_positions(qualifying), ["race_id", "driver_id"], "left")
    assert sorted(map(tuple, joined.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_the_era_is_looked_up_once_for_all_tables(spark):
    races = spark.createDataFrame([(str(i), str(1990 + i), "1") for i in range(40)] + [(None, "2005", "1")],
                                  "raceId string, year string, round string")
    tables = {"races": races, **{n: spark.range(400).select((F.col("id") % 50).cast("string").alias("raceId"), "id")
                                 for n in ("results", "qualifying", "pit_stops", "lap_times")}}
    out = filter_modern_era(tables, 2000, 2009)
    assert out["races"].count() == 11
    for n in ("results", "qualifying", "pit_stops", "lap_times"):
        plan = out[n]._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
        assert "kept-races" in plan and out[n].count() == 80

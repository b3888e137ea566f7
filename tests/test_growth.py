"""Steps whose cost per row, or whose memory per task, must not grow with the tables."""

import pytest
from pyspark.sql import functions as F

from pitlane.functions import exprs as X
from pitlane.operators.order import placed
from pitlane.plans import standin_catalog as cat
from pitlane.plans.registry import REGISTRY
from pitlane.session import compilable_code
from pitlane.sources.records import field_count, is_refused
from pitlane.streaming import incremental


def test_generated_methods_stay_compilable(spark):
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    try:
        spark.conf.unset(key)
        compilable_code(spark)
        assert spark.conf.get(key) == "8000"
        spark.conf.set(key, "20000")  # a session's own choice stays
        compilable_code(spark)
        assert spark.conf.get(key) == "20000"
    finally:
        spark.conf.set(key, before)


def test_numbers_are_checked_before_the_cast(spark):
    rows = [("7", 7, 7.0), ("007.0", 7, 7.0), ("+1e3", 1000, 1000.0), (" -7 ", -7, -7.0), (".5", None, 0.5),
            ("5.", 5, 5.0), ("1-2", None, None), ("1e", None, None), ("1d", None, None), ("NaN", None, None),
            ("7\n", None, None), ("", None, None), ("9223372036854775808", None, 9223372036854775808.0),
            ("9007199254740993.0", 9007199254740993, 9007199254740992.0), (None, None, None)]
    df = spark.createDataFrame(rows, "v string, l long, d double").select(
        "l", "d", X.to_long("v").alias("to_l"), X.to_double("v").alias("to_d"))
    assert [(r.to_l, r.to_d) for r in df.collect()] == [r[1:] for r in rows]
    assert "translate" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_fields_are_counted_without_a_split(spark):
    rows = [("", 1), ("a", 1), ("a,,b", 3), (",", 2), ('"a,b",c', 2), ("ä,ö", 2)]
    df = spark.createDataFrame(rows, "r string, n int").select("n", field_count(F.col("r")).alias("m"))
    assert [r.m for r in df.collect()] == [n for _, n in rows]
    assert "split(" not in df._jdf.queryExecution().optimizedPlan().toString()
    kinds = spark.createDataFrame([(None,), ("too_long",), ("too_short",)], "k string")
    assert [r[0] for r in kinds.select(is_refused(F.col("k"))).collect()] == [False, True, False]


def test_buckets_grow_with_the_tables(spark, monkeypatch):
    monkeypatch.setattr(cat, "BUCKET_ROWS", 10)
    assert cat.buckets_for(spark.range(5), spark.range(20)) == cat.BUCKETS
    assert cat.buckets_for(spark.range(5), spark.range(201)) == 21


def test_first_batch_is_written_once_and_nulls_keep_their_rows(spark, tmp_path, monkeypatch):
    schema = "result_id long, points double, year long"
    target = str(tmp_path / "fact")
    rows = [(1, 1.0, 2000), (1, 2.0, 2001), (None, 1.0, 2000), (None, 1.0, 2000), (None, 2.0, 2000), (2, None, None)]

    def aside(*_):
        pytest.fail("nothing is stored yet, so nothing needs writing aside")

    with monkeypatch.context() as m:
        m.setattr(incremental, "scratch_path", aside)
        incremental.upsert_seasons(spark.createDataFrame(rows, schema), target)
    kept = [(1, 1.0, 2000), (2, None, None), (None, 1.0, 2000), (None, 2.0, 2000)]

    def stored():
        back = spark.read.schema(schema).parquet(target).select("result_id", "points", "year").collect()
        return sorted(map(tuple, back), key=repr)

    assert stored() == sorted(kept, key=repr)
    incremental.upsert_seasons(spark.createDataFrame(rows[2:], schema), target)
    assert stored() == sorted(kept, key=repr)


def race_tables(spark, folder):
    """Seventeen entries of four races, one before the era, with repeated result ids and a missing supplier."""
    lines = [(o, n, 20 * o + n, o % 3 + 1, n, float(10 + n), "R" if n == 2 else "N", "F")
             for o in range(1, 5) for n in range(1, 5)] + [(4, 4, 5, 2, 4, 50.0, "N", "O")]
    frames = {
        "lineitem": spark.createDataFrame([(o, p, s, n, q, f, t) for o, _, p, s, n, q, f, t in lines], """l_orderkey long,
            l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, l_linestatus string"""),
        "orders": spark.sql("""SELECT id AS o_orderkey, id AS o_custkey,
            timestamp_ntz'1995-06-01 00:00:00' + make_interval(id - 1) AS o_orderdate FROM range(1, 5)"""),
        "supplier": spark.sql("SELECT id AS s_suppkey, id AS s_nationkey FROM range(1, 3)"),
    }
    for name in cat.S.SOURCE_TABLES:
        frames.get(name, spark.range(1)).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def test_queries_of_few_result_columns_write_no_whole_table(spark, tmp_path, monkeypatch):
    sf = race_tables(spark, tmp_path / "sf")
    monkeypatch.setattr(cat, "_MEMO", {})
    written, store = [], cat.stored

    def noting(df, name):
        written.append((name, df.columns))
        return store(df, name)

    monkeypatch.setattr(cat, "stored", noting)
    columns = ["result_id", "race_id", "constructor_id", "grid", "points", "position_numeric", "finished"]
    names = ("safe_div_pct", "round_half_even", "results_order_by_points")
    few = {n: sorted(map(tuple, REGISTRY[n](spark, sf).collect()), key=repr) for n in names}
    narrow = sorted(map(tuple, cat.cleaned_results(spark, sf, columns).collect()))
    assert written == [("entry_points", ["result_id", "points"])]
    whole = sorted(map(tuple, cat.cleaned(spark, sf)["results"].select(*columns).collect()))
    assert narrow == whole and len(whole) == 8  # orders 3 and 4; order 2 has no supplier, order 1 no season
    assert [n for n, _ in written[1:]] == ["result_lines", "results_clean"] and "_seq" not in written[1][1]
    assert {n: sorted(map(tuple, REGISTRY[n](spark, sf).collect()), key=repr) for n in names} == few


def test_ordered_rows_are_not_shuffled_again(spark):
    df = spark.createDataFrame([(i, i % 2) for i in range(20)], "id long, v int")
    out = placed(df, [F.desc("v"), F.asc("id")], ranges=4)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "rightHint=(strategy=broadcast)" in plan
    assert [r.id for r in sorted(out.collect(), key=lambda r: r.place)] == [*range(1, 20, 2), *range(0, 20, 2)]


def test_whole_numbers_with_a_point_need_no_double(spark):
    rows = [("9007199254740993.00", 9007199254740993), ("-0.0", 0), ("+5.", 5), ("9223372036854775807.0", 2**63 - 1),
            ("9223372036854775808.0", None), ("7.0\n", None), (" 7.0 ", 7), ("7.05", None), (".0", 0), ("70e-1", 7)]
    df = spark.createDataFrame(rows, "v string, l long")
    assert [r.n for r in df.select(X.to_long("v").alias("n")).collect()] == [r[1] for r in rows]
    assert "substring_index" in df.select(X.to_long("v"))._jdf.queryExecution().optimizedPlan().toString()

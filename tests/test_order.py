import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from pitlane.operators.order import in_ranges, placed


@pytest.fixture(scope="module")
def rows(spark):
    """Half of all rows share one value; groups from one row to most of them; nulls in both."""
    rnd = random.Random(7)
    data = [(rnd.choice([2000, 2000, 2000, 2001, None, 3000 + i]), i, rnd.choice([5.0, 5.0, None, float(rnd.randint(0, 30))]), "p")
            for i in range(6000)]
    return spark.createDataFrame(data, "year long, driver_id long, points double, `a.b` string").repartition(5)


def numbered(df, by, group):
    return df.withColumn("want", F.row_number().over(Window.partitionBy(*group).orderBy(*by)))


@pytest.mark.parametrize("group", [[], ["year"]])
@pytest.mark.parametrize("ranges", [1, 7])
def test_place_is_row_number(spark, rows, group, ranges):
    by = [F.desc_nulls_last("points"), F.asc("driver_id")]
    got = placed(rows, by, group, ranges=ranges)
    assert got.columns == ["year", "driver_id", "points", "a.b", "place"]
    both = got.join(numbered(rows, by, group).select("driver_id", "want"), "driver_id")
    assert both.count() == 6000
    assert both.where("place <> want").count() == 0


def test_a_hot_value_is_dealt_to_several_tasks(spark, rows):
    df = in_ranges(rows, [F.desc_nulls_last("points"), F.asc("driver_id")], "at", 8)
    sizes = [r["count"] for r in df.groupBy(F.shiftright("at", 33)).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 6000 / 8
    assert df.where("points = 5.0").select(F.shiftright("at", 33)).distinct().count() >= 3
    assert df.where("points = 5.0").count() > 2900


def test_odd_tables(spark, rows):
    assert placed(rows.where("false"), [F.asc("driver_id")]).collect() == []
    same = spark.createDataFrame([(1, "x")] * 9, "v long, _at string")
    got = placed(same, [F.asc("v")], out="_at")  # an existing column is replaced
    assert sorted(r["_at"] for r in got.collect()) == list(range(1, 10)) and got.columns == ["v", "_at"]
    one = spark.createDataFrame([(1, 2, 3, 4, 5)], "_at long, _range long, _first long, _before long, n long")
    assert placed(one, [F.asc("n")], ["_range"]).first()["place"] == 1


def test_calendar_is_sorted(spark):
    import datetime

    from pitlane.operators.star import build_dim_date, calendar
    days = [datetime.date(2020, 1, 1) + datetime.timedelta(days=(i * 37) % 200) for i in range(300)]
    races = spark.createDataFrame([(d,) for d in days] + [(None,)], "date date")
    out = [(r.date, r.place) for r in calendar(build_dim_date(races)).collect()]
    assert out == [(d, i + 1) for i, d in enumerate(sorted(set(days)))]

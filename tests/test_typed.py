import datetime

import pytest

from pitlane.plans import standin_catalog as cat
from pitlane.plans.sqlmodels import STAGING_COLUMNS, csv_staging
from pitlane.sources.typed import csv_source, inferred_types, register_csv_sources, type_of

SF = "/root/testdata/sf0.001"


def write(folder, name, text):
    (folder / name).write_text(text)
    return str(folder / name)


def test_types_are_the_least_that_hold_all_values(spark, tmp_path):
    rows = [("1", "1", "1.5", "2020-01-31", "a", "", "1", "2020-01-31", "9223372036854775807", "9223372036854775808", "007", "1e3"),
            ("-2", "2.0", "x", "2021-12-01", "1", "", "\\N", "7", "0", "1", "12", "-.5"),
            (" 3 ", "NA", "3", "", "2", "NULL", "", "", "-1", "2", "3", "4.")]
    head = "whole,mixed,words,day,letters,none,gaps,day_or_number,largest,beyond,padded,science"
    path = write(tmp_path, "t.csv", "\n".join([head, *[",".join(r) for r in rows]]) + "\n")
    df = csv_source(spark, path)
    assert dict(df.dtypes) == {
        "whole": "bigint", "mixed": "double", "words": "string", "day": "date", "letters": "string", "none": "string",
        "gaps": "bigint", "day_or_number": "string", "largest": "bigint", "beyond": "string", "padded": "bigint", "science": "double"}
    first, second, third = df.collect()
    assert first.day == datetime.date(2020, 1, 31) and first.largest == 9223372036854775807 and first.beyond == "9223372036854775808"
    assert (second.whole, second.mixed, second.science, third.whole, third.mixed) == (-2, 2.0, -0.5, 3, None)


def test_one_late_value_changes_the_type(spark):
    df = spark.range(20_000).selectExpr("cast(id as string) AS a", "IF(id = 19999, 'x', cast(id as string)) AS b",
                                        "IF(id = 12345, '1.5', cast(id as string)) AS c").repartition(6)
    assert inferred_types(df) == {"a": "bigint", "b": "string", "c": "double"}


def test_the_lattice():
    assert [type_of(b) for b in range(16)] == ["string", "bigint", "double", "double", "date", *["string"] * 11]


def test_declared_types_and_missing_files(spark, tmp_path):
    path = write(tmp_path, "t.csv", "a,b\n1,2\nx,3\n")
    assert csv_source(spark, path, {"a": "bigint"}).collect() == [(1, 2), (None, 3)]
    with pytest.raises(FileNotFoundError):
        csv_source(spark, str(tmp_path / "no.csv"))
    assert csv_source(spark, write(tmp_path, "h.csv", "a,b\n")).dtypes == [("a", "string"), ("b", "string")]


def test_views_for_sql(spark, tmp_path):
    write(tmp_path, "races_clean.csv", "race_id,year,date\n1,2000,2000-03-12\n2,2001,2001-03-04\n")
    register_csv_sources(spark, str(tmp_path), ["races"], prefix="typed_")
    row = spark.sql("SELECT max(year) AS y, max(date) AS d, sum(race_id) AS n FROM typed_races").first()
    assert (row.y, row.d, row.n) == (2001, datetime.date(2001, 3, 4), 3)


@pytest.mark.parametrize("view", ["stg_results", "stg_races", "stg_pit_stops"])
def test_staging_over_csv_has_the_rows_and_types_of_the_models(spark, view):
    from pitlane.plans.sqlmodels import source_of
    want = cat.models(spark, SF)[view]
    got = csv_staging(spark, cat.cleaned_csv(spark, SF, [source_of(view)]), [view])[view]
    assert got.columns == STAGING_COLUMNS[view]
    kinds = {"int": "bigint"}
    filled = [c for c, t in want.dtypes if want.where(f"{c} IS NOT NULL").limit(1).count()]
    typed, model = dict(got.dtypes), dict(want.dtypes)
    for c in filled:  # a double column of whole values only is read as whole numbers
        assert typed[c] == kinds.get(model[c], model[c]) or (typed[c], model[c]) == ("bigint", "double"), c
    alike = got.selectExpr(*[f"cast({c} AS {model[c]}) AS {c}" for c in got.columns])
    assert sorted(map(str, map(tuple, alike.collect()))) == sorted(map(str, map(tuple, want.collect())))

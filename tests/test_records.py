import pytest

from pitlane.sources.ingest import ingest_all_tables, load_raw_table, quarantine, read_raw_csv
from pitlane.sources.records import MalformedRecordsError, malformed_records

LINES = ["statusId,status,note", "1,Finished,ok", "2,Lost,a,b", "3,Short", "", '4,"broken,x', '5,"with, comma","he said ""no"""',
         '6,in"side,y', "7,,", '8,"a"b,c', "9,x,y,", '10,"","z"', "11", '12,plain,"unclosed', "13,Finished,ok"]
KINDS = {3: ("too_long", 4), 4: ("too_short", 2), 6: ("broken_quote", 3), 10: ("broken_quote", 3), 11: ("too_long", 4),
         13: ("too_short", 1), 14: ("broken_quote", 3)}


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "status.csv").write_text("\n".join(LINES) + "\n")
    return str(tmp_path)


def test_report_has_file_line_kind_and_record(spark, folder):
    rows = malformed_records(spark, f"{folder}/status.csv").collect()
    assert {r.line: (r.kind, r.fields) for r in rows} == KINDS
    assert all(r.record == LINES[r.line - 1] and r.file.endswith("/status.csv") for r in rows)


def test_only_whole_records_are_loaded(spark, folder):
    df = read_raw_csv(spark, f"{folder}/status.csv")
    rows = {r.statusId: (r.status, r.note) for r in df.collect()}
    assert sorted(rows, key=int) == ["1", "3", "5", "6", "7", "10", "11", "13"]
    assert rows["3"] == ("Short", None) and rows["11"] == (None, None)
    assert rows["5"] == ("with, comma", 'he said "no"') and rows["6"] == ('in"side', "y")
    assert df.select("note").count() == df.count() == 8  # pruned columns change nothing
    strict = read_raw_csv(spark, f"{folder}/status.csv", refused=("too_long", "too_short", "broken_quote"))
    assert strict.count() == 6


def test_strict_mode_raises_and_the_rest_goes_on(spark, folder, tmp_path):
    with pytest.raises(MalformedRecordsError, match=r"line 3: too_long \(4 fields\); status.csv line 6: broken_quote"):
        load_raw_table(spark, "status", folder, validate=False, strict=True)
    (tmp_path / "seasons.csv").write_text("year,url\n2000,a\n2001\n")
    tables, report = ingest_all_tables(spark, folder, strict=True)
    states = {r.table: (r.status, r.error) for r in report.collect()}
    assert states["status"][0] == "malformed" and "line 3" in states["status"][1]
    assert states["seasons"] == ("loaded", None) and tables["seasons"].count() == 2  # a short record is no error
    tables, report = ingest_all_tables(spark, folder)
    assert {r.table for r in report.where("status = 'loaded'").collect()} == {"seasons", "status"}
    assert tables["status"].count() == 8


def test_quarantine_of_all_tables(spark, folder, tmp_path):
    (tmp_path / "seasons.csv").write_text("year,url\n2000,b,c,d\n2001\n")
    rows = quarantine(spark, folder).collect()
    assert {(r.table, r.line, r.kind, r.loaded) for r in rows if r.table == "seasons"} == {
        ("seasons", 2, "too_long", False), ("seasons", 3, "too_short", True)}
    assert sum(r.table == "status" for r in rows) == len(KINDS)
    assert load_raw_table(spark, "seasons", folder, tag=False).select("year").collect()[0].year == "2001"


def test_lines_are_counted_over_splits_and_files(spark, tmp_path):
    folder = tmp_path / "status.csv"
    folder.mkdir()
    want = set()
    for f in "ab":
        lines = ["statusId,status"]
        for i in range(400):
            bad = i % 37 == 5
            lines.append(f"{i},{'x' * (i % 50)}" + (",more" if bad else ""))
            if bad:
                want.add((f"part-{f}.csv", len(lines)))
        (folder / f"part-{f}.csv").write_text("\n".join(lines))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        bad = malformed_records(spark, str(folder))
        assert {(r.file.rsplit("/", 1)[-1], r.line) for r in bad.collect()} == want
        good = read_raw_csv(spark, str(folder))
        assert good.rdd.getNumPartitions() > 4 and good.count() == 800 - len(want)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_records_over_several_lines(spark, tmp_path):
    (tmp_path / "q.csv").write_text('statusId,status\n1,"two\nlines"\n2,b,c\n3\n')
    rows = {r.statusId: r.status for r in read_raw_csv(spark, str(tmp_path / "q.csv"), quoted_newlines=True).collect()}
    assert rows == {"1": "two\nlines", "3": None}


def test_empty_files(spark, tmp_path):
    (tmp_path / "none.csv").write_text("")
    (tmp_path / "head.csv").write_text("a,b\n")
    assert malformed_records(spark, str(tmp_path / "none.csv")).count() == 0
    assert malformed_records(spark, str(tmp_path / "head.csv")).count() == 0
    assert read_raw_csv(spark, str(tmp_path / "head.csv")).collect() == []
    assert read_raw_csv(spark, str(tmp_path / "none.csv")).columns == ["_seq"]

"""CSV scan and periods from file names."""

import datetime

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from sieveline import file_period, metrics, period_of, process_feed, read_feed

NOON = datetime.datetime(2025, 2, 1, 12, tzinfo=datetime.timezone.utc)
SCAN_ERRORS = (PySparkException, Py4JJavaError)
CONFIG = {"units": {"columns": {"ID": {"type": "positive_number"}, "ACR": {"type": "string_length", "length": 3}}}}


@pytest.fixture
def write(tmp_path):
    def build(name, text):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
        return str(path)

    return build


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_everything_is_text(spark, write):
    path = write("a.csv", 'A,B,C d\n1,"",2024-01-01\n\n04,NaN, x \n5\n6,null,"q,r",extra\n')
    df = read_feed(spark, path)
    assert df.dtypes == [("A", "string"), ("B", "string"), ("C d", "string")]
    assert rows(df) == [
        ("1", None, "2024-01-01"),
        ("04", "NaN", " x "),
        ("5", None, None),
        ("6", "null", "q,r"),
    ]


def test_repeated_and_empty_headers(spark, write):
    path = write("a.csv", "A,A,b,\n1,2,3,4\n")
    df = read_feed(spark, path, check_header=False)
    assert df.columns == ["A0", "A1", "b", "_c3"]
    assert rows(df) == [("1", "2", "3", "4")]
    with pytest.raises(SCAN_ERRORS, match="header"):
        rows(read_feed(spark, path))


def test_many_files_with_one_layout(spark, write):
    paths = [write("f/1.csv", "A,B\n1,2\n"), write("f/2.csv", "A,B\n3,4\n")]
    for source in (paths, paths[0].rsplit("/", 1)[0]):
        assert sorted(rows(read_feed(spark, source))) == [("1", "2"), ("3", "4")]
        assert sorted(rows(read_feed(spark, source, ["A", "B"]))) == [("1", "2"), ("3", "4")]


def test_other_layout_fails_instead_of_being_mixed_up(spark, write):
    paths = [write("f/1.csv", "A,B\n1,2\n"), write("f/2.csv", "B,A\n3,4\n")]
    for columns in (None, ["A", "B"]):
        with pytest.raises(SCAN_ERRORS, match="header"):
            rows(read_feed(spark, paths, columns))


def test_given_columns_start_no_job(spark, write):
    path = write("a.csv", "A,B\n1,2\n")
    spark.sparkContext.setJobGroup("scan", "")
    read_feed(spark, path, ["A", "B"])
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("scan")
    read_feed(spark, path)
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("scan")) == 1
    spark.sparkContext.setJobGroup("", "")


@pytest.mark.parametrize(
    "path,period",
    [("/x/202501_hours.csv", 202501), ("202501_a_b.csv", 202501), ("000101_a.csv", 101), ("202599_a.csv", 202599)],
)
def test_period_of_a_name(path, period):
    assert period_of(path) == period


@pytest.mark.parametrize("path", ["202501.csv", "20250_a.csv", "2025011_a.csv", "units.csv", "x202501_a.csv", "٢٠٢٥٠١_a.csv"])
def test_wrong_names(path):
    with pytest.raises(ValueError, match="period"):
        period_of(path)


def test_optional_month_check():
    assert period_of("202512_a.csv", check_month=True) == 202512
    for name in ("202513_a.csv", "202500_a.csv"):
        with pytest.raises(ValueError):
            period_of(name, check_month=True)


def test_period_of_each_row(spark, write):
    paths = [write("f/202501_u.csv", "A\n1\n2\n"), write("f/202502_u.csv", "A\n3\n")]
    df = read_feed(spark, paths).select(file_period().alias("P"), "A")
    assert df.dtypes[0] == ("P", "int")
    assert sorted(rows(df)) == [(202501, "1"), (202501, "2"), (202502, "3")]


def test_wrong_name_fails_the_scan(spark, write):
    paths = [write("f/202501_u.csv", "A\n1\n"), write("f/notes.csv", "A\n3\n")]
    with pytest.raises(SCAN_ERRORS, match="notes.csv"):
        rows(read_feed(spark, paths).select(file_period().alias("P")))
    write("g/202513_u.csv", "A\n1\n")
    with pytest.raises(SCAN_ERRORS, match="202513_u.csv"):
        rows(read_feed(spark, paths[0].rsplit("/", 2)[0] + "/g").select(file_period(check_month=True)))


def test_feed_run(spark, write):
    write("f/202501_units.csv", "ID,ACR,MORE\n04,ABC,a\n5,AB,b\n")
    pattern = write("f/202502_units.csv", "ID,ACR,MORE\n6,XYZ,c\n").replace("202502", "*")
    run = process_feed(spark, CONFIG, "units", pattern, ingested_at=NOON)
    assert run.raw.columns == ["ID", "ACR", "MORE", "DINS"] and run.raw.count() == 3
    assert sorted(rows(run.good.drop("DINS"))) == [(202501, 4.0, "ABC", "a"), (202502, 6.0, "XYZ", "c")]
    assert rows(run.rejects.drop("DINS")) == [(202501, "5", "AB", "b")]
    assert run.raw.select("DINS").union(run.good.select("DINS")).union(run.rejects.select("DINS")).distinct().count() == 1
    counts = metrics(run.raw.drop("DINS"), run.rules, file_period())
    assert {(r.ID_PER, r.metric): r.rows_ok for r in counts.collect()}[202501, "good"] == 1


def test_misnamed_file_fails_the_run_whatever_it_holds(spark, write):
    """A file of which every row would be rejected counts as well."""
    write("f/202501_units.csv", "ID,ACR\n1,ABC\n")
    folder = write("f/wrong.csv", "ID,ACR\nx,AB\n").rsplit("/", 1)[0]
    for path in (folder, f"{folder}/*.csv"):
        with pytest.raises(ValueError, match="1 file name.*'wrong.csv'"):
            process_feed(spark, CONFIG, "units", path)
    assert process_feed(spark, CONFIG, "units", folder, period=202501).rejects.count() == 1


def test_feed_run_with_given_period(spark, write):
    path = write("units.csv", "ID,ACR\n1,ABC\n")
    assert rows(process_feed(spark, CONFIG, "units", path, period=202503).good.drop("DINS")) == [(202503, 1.0, "ABC")]
    with pytest.raises(ValueError, match="units.csv"):
        process_feed(spark, CONFIG, "units", path)


def test_feed_is_checked_before_reading(spark):
    with pytest.raises(ValueError, match="not in the configuration"):
        process_feed(spark, CONFIG, "staff", "/does/not/exist/202501_staff.csv")


def test_reserved_header(spark, write):
    path = write("202501_u.csv", "ID,DINS\n1,2\n")
    with pytest.raises(ValueError, match="reserved"):
        process_feed(spark, CONFIG, "units", path)

"""Clean-and-split, on feeds with the kinds of dirt real ones have."""

import datetime
import logging

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sieveline import clean, filter_equals, metrics, parse_rules, to_target, union_feeds, with_flags

NOON = datetime.datetime(2025, 2, 1, 12, tzinfo=datetime.timezone.utc)
STAFF_COLUMNS = ["CODE", "Full Name", "BORN", "PAY", "NOTE"]
STAFF_RULES = parse_rules(
    {
        "CODE": {"type": "string_length", "length": 4},
        "Full Name": {"type": "string_no_numbers"},
        "BORN": {"type": "date", "format": "yyyy-MM-dd"},
        "PAY": {"type": "positive_number"},
    }
)
# (row, columns that fail)
STAFF = [
    (("AB12", "Ada Lovelace", "1975-12-10", "0120.50", "x"), set()),
    (("AB13", "Niels Bohr", "1985-10-07", "0", None), set()),
    (("AB1", "Max Born", "1982-12-11", "10", None), {"CODE"}),
    (("AB145", "Max Planck", "1958-04-23", "10", None), {"CODE"}),
    (("AB16", "M4x Planck", "1958-04-23", "10", None), {"Full Name"}),
    (("AB17", None, "1958-04-23", "10", None), {"Full Name"}),
    (("AB18", "Lise Meitner", "07-11-1978", "10", None), {"BORN"}),
    (("AB19", "Lise Meitner", "1978-02-30", "10", None), {"BORN"}),
    (("AB20", "Lise Meitner", "1978-11-077", "10", None), {"BORN"}),
    (("AB21", "Emmy Noether", "1982-03-23", "-5", None), {"PAY"}),
    (("AB22", "Emmy Noether", "1982-03-23", "ten", None), {"PAY"}),
    (("AB23", "Emmy Noether", "1982-03-23", "NaN", None), {"PAY"}),
    (("AB24", "Emmy Noether", "1982-00-23", None, None), {"PAY", "BORN"}),
    ((None, None, None, None, None), {"CODE", "Full Name", "BORN", "PAY"}),
]


@pytest.fixture
def staff(texts):
    return texts(STAFF_COLUMNS, [row for row, _ in STAFF])


def test_good_rows(staff):
    good = clean(staff, STAFF_RULES, 202501, NOON).good
    assert good.dtypes == [
        ("ID_PER", "int"),
        ("CODE", "string"),
        ("Full Name", "string"),
        ("BORN", "date"),
        ("PAY", "double"),
        ("NOTE", "string"),
        ("DINS", "timestamp"),
    ]
    rows = [tuple(r)[:-1] for r in good.collect()]
    assert rows == [
        (202501, "AB12", "Ada Lovelace", datetime.date(1975, 12, 10), 120.5, "x"),
        (202501, "AB13", "Niels Bohr", datetime.date(1985, 10, 7), 0.0, None),
    ]
    assert good.select(F.date_format("DINS", "yyyy-MM-dd HH:mm").alias("d")).distinct().collect() == [("2025-02-01 12:00",)]


def test_rejects_stay_text(staff):
    rejects = clean(staff, STAFF_RULES, 202501, NOON).rejects
    assert rejects.columns == ["ID_PER", *STAFF_COLUMNS, "DINS"]
    assert {t for c, t in rejects.dtypes if c in STAFF_COLUMNS} == {"string"}
    assert [tuple(r)[1:-1] for r in rejects.collect()] == [row for row, failed in STAFF if failed]


def test_metrics_of_the_feed(staff):
    got = {r.metric: r.rows_ok for r in metrics(staff, STAFF_RULES).collect()}
    want = {"raw": len(STAFF), "good": 2, "rejects": len(STAFF) - 2}
    want |= {f"passed:{c}": sum(c not in failed for _, failed in STAFF) for c in STAFF_RULES}
    assert got == want


def test_metrics_by_period(texts):
    df = texts(["V", "P"], [("1", "202501"), ("x", "202501"), (None, "202502")])
    out = metrics(df, parse_rules({"V": {"type": "positive_number"}}), F.col("P").try_cast("int"))
    assert out.dtypes == [("ID_PER", "int"), ("metric", "string"), ("rows_ok", "bigint")]
    assert {tuple(r) for r in out.collect()} == {
        (202501, "raw", 2), (202501, "good", 1), (202501, "rejects", 1), (202501, "passed:V", 1),
        (202502, "raw", 1), (202502, "good", 0), (202502, "rejects", 1), (202502, "passed:V", 0),
    }


def test_metrics_of_a_tagged_frame(spark):
    df = spark.createDataFrame([(202501, "1"), (202501, "x"), (202502, "2")], "ID_PER int, V string")
    out = metrics(df, parse_rules({"V": {"type": "positive_number"}}), F.col("ID_PER")).where("metric = 'good'")
    assert sorted(tuple(r) for r in out.collect()) == [(202501, "good", 1), (202502, "good", 1)]


def test_metrics_while_writing(staff, tmp_path):
    seen = Observation()
    good = clean(staff, STAFF_RULES, 202501, NOON, observation=seen).good
    good.write.parquet(str(tmp_path / "good"))
    assert seen.get == {r.metric: r.rows_ok for r in metrics(staff, STAFF_RULES).collect()}
    assert sorted(good.collect()) == sorted(clean(staff, STAFF_RULES, 202501, NOON).good.collect())


def test_metrics_of_an_empty_feed(texts):
    df = texts(["V"], [])
    got = {r.metric: r.rows_ok for r in metrics(df, parse_rules({"V": {"type": "email"}})).collect()}
    assert got == {"raw": 0, "good": 0, "rejects": 0, "passed:V": 0}


def test_no_rule_means_all_good(texts, caplog):
    df = texts(["A"], [("x",), (None,)])
    with caplog.at_level(logging.WARNING):
        result = clean(df, parse_rules({"B": {"type": "email"}}), 1, NOON)
    assert "['B'] are not in the feed" in caplog.text
    assert result.good.count() == 2 and result.rejects.count() == 0


def test_column_lookup_is_exact_case(texts):
    df = texts(["name"], [("R2D2",)])
    assert clean(df, parse_rules({"NAME": {"type": "string_no_numbers"}}), 1, NOON).good.count() == 1


def test_skipped_columns_are_converted_not_checked(texts):
    rules = parse_rules(
        {"N": {"type": "positive_number", "skip_validation": True}, "D": {"type": "date", "skip_validation": True}}
    )
    df = texts(["N", "D"], [("1.5", "2024-02-29"), ("abc", "2023-02-30"), ("-1", "2023-1-1")])
    result = clean(df, rules, 1, NOON)
    assert result.rejects.count() == 0
    got = result.good.select("N", F.col("D").cast("string")).collect()
    assert [tuple(r) for r in got] == [(1.5, "2024-02-29"), (None, None), (-1.0, None)]


def test_several_rules_on_one_column(texts):
    rules = parse_rules({"N": [{"type": "number"}, {"type": "non_negative"}, {"type": "string_length", "length": 2}]})
    df = texts(["N"], [("10",), ("-1",), ("1e",), ("5",), ("-0",), ("NaN",), (None,)])
    assert [r.N for r in clean(df, rules, 1, NOON).good.collect()] == [10.0, 0.0]
    assert {r.metric: r.rows_ok for r in metrics(df, rules).collect()}["passed:N"] == 2


@pytest.mark.parametrize("name", ["ID_PER", "DINS", "id_per", "Dins"])
def test_reserved_names(texts, name):
    with pytest.raises(ValueError, match="reserved"):
        clean(texts(["A", name], []), {}, 1, NOON)
    with pytest.raises(ValueError, match="reserved"):
        clean(texts(["A"], []), parse_rules({name: {"type": "email"}}), 1, NOON)


def test_the_period_cannot_have_a_rule(texts):
    rules = parse_rules({"ID_PER": {"type": "positive_number"}})
    with pytest.raises(ValueError, match="cannot have a rule"):
        metrics(texts(["ID_PER"], []), rules, 202501)
    assert metrics(texts(["ID_PER"], [("1",)]), rules).count() == 4


def test_names_a_helper_column_could_have(texts):
    columns = ["valid", "valid_A", "A", "a.b", "x`y", "__passed_0", "raw", "key"]
    rules = parse_rules({c: {"type": "positive_number"} for c in ["A", "a.b", "x`y", "__passed_0"]})
    df = texts(columns, [("f", "g", "1", "2", "3", "4", "h", "k"), ("f", "g", "1", "2", "x", "4", "h", "k")])
    seen = Observation()
    result = clean(df, rules, 1, NOON, observation=seen)
    assert [tuple(r)[:-1] for r in result.good.collect()] == [(1, "f", "g", 1.0, 2.0, 3.0, 4.0, "h", "k")]
    assert result.good.columns == ["ID_PER", *columns, "DINS"]
    assert result.rejects.count() == 1
    assert {r.metric: r.rows_ok for r in metrics(df, rules).collect()} == seen.get


def test_run_number_and_default_timestamp(texts):
    df = texts(["A"], [("1",), ("x",)])
    result = clean(df, parse_rules({"A": {"type": "positive_number"}}), 7, period_name="IDRUN")
    assert result.good.columns == ["IDRUN", "A", "DINS"]
    first, again = result.good.first(), result.good.first()
    assert first == again and first.DINS == result.rejects.first().DINS


def test_union_by_name(texts):
    out = union_feeds({"a": texts(["X", "Y"], [("1", "2")]), "b": texts(["Y", "Z"], [("3", "4")])})
    assert {tuple(r) for r in out.select("feed", "X", "Y", "Z").collect()} == {("a", "1", "2", None), ("b", None, "3", "4")}
    with pytest.raises(ValueError, match="already has"):
        union_feeds({"a": texts(["FEED"], [])})
    with pytest.raises(ValueError, match="no feeds"):
        union_feeds({})


def test_filter_equals(texts):
    df = texts(["A.B"], [("x",), ("y",), (None,)])
    assert [tuple(r) for r in filter_equals(df, "A.B", "x").collect()] == [("x",)]


def test_target_layout(texts):
    feed = texts(["UNIT", "ACR", "MORE"], [("1", "XYZ", "m")])
    good = clean(feed, parse_rules({"UNIT": {"type": "positive_number"}}), 7, NOON, period_name="IDRUN").good
    layout = parse_rules({"DESC": {"type": "string_length", "length": 3}, "UNIT": {"type": "positive_number"}})
    out = to_target(good, layout, {"IDRUN": "ID_PER", "ACR": "DESC"})
    assert out.columns == ["ID_PER", "DESC", "UNIT"]
    assert [tuple(r) for r in out.collect()] == [(7, "XYZ", 1.0)]


def test_target_layout_reports_missing_columns(texts):
    good = clean(texts(["UNIT"], []), {}, 1, NOON).good
    layout = parse_rules({c: {"type": "email"} for c in ["UNIT", "DESC", "unit"]})
    with pytest.raises(ValueError, match="\\['DESC', 'unit'\\]"):
        to_target(good, layout)
    with pytest.raises(ValueError, match="to rename are missing: \\['NAME'\\]"):
        to_target(good, layout, {"NAME": "DESC"})
    with pytest.raises(ValueError, match="repeated"):
        to_target(good, layout, {"UNIT": "dins"})


DIRTY = st.one_of(
    st.none(),
    st.sampled_from(["0", "12", "-1", "1.5", "2024-02-29", "2023-02-29", "a@b.it", "a@b", "abc", "", "x1", "12\n", "NaN"]),
    st.text(alphabet="01239-.@aZé \n", max_size=12),
)


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=st.lists(st.tuples(DIRTY, DIRTY, DIRTY, DIRTY, DIRTY), max_size=40))
def test_good_and_rejects_are_all_rows(texts, rows):
    columns = ["N", "D", "M", "L", "S"]
    rules = parse_rules(
        {
            "N": {"type": "positive_number"},
            "D": {"type": "date"},
            "M": {"type": "email"},
            "L": {"type": "string_length", "length": 3},
            "S": {"type": "string_no_numbers"},
        }
    )
    df = texts(["ROW", *columns], [(str(i), *row) for i, row in enumerate(rows)])
    _, flags = with_flags(df, rules)
    by_column = {c: [] for c in columns}
    nulls = [F.col(c).isNull().alias(f"{c}_null") for c in columns]
    for row in df.select(*[flag.alias(c) for c, flag in flags.items()], *nulls).collect():
        for c in columns:
            assert row[c] is not None and not (row[c] and row[f"{c}_null"])
            by_column[c].append(row[c])

    # Each rule alone, so that good rows are common: all ten branches in one job.
    branches = []
    for c in columns:
        result = clean(df, {c: rules[c]}, 1, NOON)
        for name, branch in {"good": result.good, "rejects": result.rejects}.items():
            text = [F.col(x).cast("string").alias(x) for x in ["ROW", *columns]]
            branches.append(branch.select(F.lit(c).alias("rule"), F.lit(name).alias("branch"), *text))
    out = branches[0]
    for branch in branches[1:]:
        out = out.unionByName(branch)
    seen = {(c, name): [] for c in columns for name in ("good", "rejects")}
    for row in out.collect():
        seen[row["rule"], row["branch"]].append(row)
    for c in columns:
        good = {int(r["ROW"]) for r in seen[c, "good"]}
        rejects = {int(r["ROW"]) for r in seen[c, "rejects"]}
        assert good == {i for i, ok in enumerate(by_column[c]) if ok}
        assert rejects == set(range(len(rows))) - good
        assert len(seen[c, "good"]) + len(seen[c, "rejects"]) == len(rows)
        assert all(r[c] is not None for r in seen[c, "good"])
        assert all(tuple(r)[3:] == rows[int(r["ROW"])] for r in seen[c, "rejects"])

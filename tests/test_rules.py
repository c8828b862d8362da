"""Edge values of every rule, in Spark and against the rule's definition in SQL."""

import datetime
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from sieveline.acceptance import oracles
from sieveline.functions import predicates as p

# predicate -> (passing, failing)
NUMBERS = (["0", "007", "3.50", "12", "9" * 400], ["-1", "-0", "+5", "1e3", ".5", "5.", " 5", "5 ", "NaN", "", None, "٣", "12\n", "1.2.3"])
EDGES = {
    "positive_number": (p.positive_number, *NUMBERS),
    "is_number": (p.is_number, *NUMBERS),
    "number": (p.number, ["0", "-1", "-0", "3.50", "-12.5"], ["+5", "--1", "1e3", ".5", "5.", " 5", "NaN", "", None, "-", "1\n"]),
    "non_negative": (p.non_negative, ["0", "5", "-0", "NaN", "1e3", " 5"], ["-1", "-0.01", "abc", "", None]),
    "iso_date": (
        p.iso_date,
        ["2000-02-29", "2024-02-29", "0000-01-01", "9999-12-31", "2023-04-30"],
        [
            "1900-02-29", "2023-02-29", "2023-04-31", "2023-00-10", "2023-13-01", "2023-01-00", "2023-01-32",
            "2023-1-01", "01-02-2023", "2023-01-011", "20230-01-01", "2023-??-10", "19y4-11-07", "2023/01/01",
            "2023-01-01\n", " 2023-01-01", "2023-01-01T00", "", None, "٢٠٢٣-01-01",
        ],
    ),
    "email": (
        p.email,
        ["a.b+c@x-y.org", "A_1%-@h.IT", "x@a.b.cd"],
        ["a@b", "a@b.c", "@b.org", "a b@c.org", "a@b.c1", "a@@b.org", "é@b.org", "", None, "a@b.org\n", "a@b.org "],
    ),
    "string_length": (lambda c: p.string_length(c, 3), ["abc", "éab", "a\U0001f600b", "   ", "a\nb"], ["ab", "abcd", "", None]),
    "string_no_numbers": (p.string_no_numbers, ["Ann O'Hara", "", "àé", "٣"], ["Ann1", "1", None, "a1b\n"]),
}
CASES = [(name, v, True) for name, (_, ok, _) in EDGES.items() for v in ok] + [
    (name, v, False) for name, (_, _, bad) in EDGES.items() for v in bad
]


@pytest.fixture(scope="module")
def flags(spark):
    """Result of every case, in one job per rule."""
    results = {}
    for name, (predicate, ok, bad) in EDGES.items():
        df = spark.createDataFrame([(i, v) for i, v in enumerate(ok + bad)], "i int, v string")
        flagged = df.select("i", predicate(F.col("v")).alias("flag")).collect()
        by_index = {r.i: r.flag for r in flagged}
        results |= {(name, v): by_index[i] for i, v in enumerate(ok + bad)}
    return results


@pytest.mark.parametrize("name,value,expected", CASES, ids=lambda x: repr(x)[:24])
def test_edge_values(flags, name, value, expected):
    assert flags[name, value] is expected


SQL = {
    "positive_number": oracles.non_negative_number("v"),
    "number": oracles.signed_number("v"),
    "iso_date": oracles.iso_date("v"),
    "email": oracles.email("v"),
    "string_length": oracles.exact_length("v", 3),
    "string_no_numbers": oracles.no_digits("v"),
}


@pytest.mark.parametrize("name,sql", SQL.items())
def test_sql_counterpart_agrees(name, sql):
    _, ok, bad = EDGES[name]
    for value in ok + bad:
        got = duckdb.execute(f"SELECT {sql} FROM (SELECT CAST(? AS VARCHAR) AS v)", [value]).fetchone()[0]
        assert got is (value in ok), repr(value)


def test_random_text_agrees_with_sql(spark):
    """Passing values with a few characters changed, added or lost."""
    rng = random.Random(11)
    values = {None}
    for _, ok, _ in EDGES.values():
        for value in ok:
            if len(value) > 50:
                continue
            for _ in range(200):
                text = list(value)
                for _ in range(rng.randint(1, 3)):
                    i = rng.randint(0, len(text))
                    text[i : i + rng.randint(0, 1)] = rng.choice(["", *"0123456789", *"-+.@_ aZé\n\t"])
                values.add("".join(text))
    values = sorted(values, key=repr)
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string").repartition(8)
    columns = [EDGES[name][0](F.col("v")).alias(name) for name in SQL]
    got = sorted(tuple(r) for r in df.select("i", *columns).collect())
    con = duckdb.connect()
    con.execute("CREATE TABLE t (i INT, v VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", list(enumerate(values)))
    assert got == con.execute(f"SELECT i, {', '.join(SQL.values())} FROM t ORDER BY i").fetchall()
    for position in range(1, len(SQL) + 1):
        assert {row[position] for row in got} == {True, False}


def test_predicates_do_not_depend_on_ansi_mode_or_parser_policy(spark, texts):
    df = texts(["v"], [("abc",), ("2023-02-30",), ("12",), (None,)])
    flags = [p.positive_number(F.col("v")), p.iso_date(F.col("v")), p.non_negative(F.col("v"))]
    results = []
    for ansi in ("true", "false"):
        for policy in ("CORRECTED", "LEGACY", "EXCEPTION"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            spark.conf.set("spark.sql.legacy.timeParserPolicy", policy)
            try:
                results.append(df.select(*flags).collect())
            finally:
                spark.conf.unset("spark.sql.ansi.enabled")
                spark.conf.unset("spark.sql.legacy.timeParserPolicy")
    assert all(r == results[0] for r in results)


def test_every_day_of_two_centuries(spark):
    """Exactly the days a calendar has pass, leap years included."""
    days = spark.range(1895, 2106).select("id", F.explode(F.sequence(F.lit(0), F.lit(13))).alias("m"))
    days = days.select("id", "m", F.explode(F.sequence(F.lit(0), F.lit(32))).alias("d"))
    text = days.select(F.format_string("%04d-%02d-%02d", "id", "m", "d").alias("v"))
    passed = {r.v for r in text.where(p.iso_date(F.col("v"))).collect()}
    first, last = datetime.date(1895, 1, 1), datetime.date(2105, 12, 31)
    assert passed == {(first + datetime.timedelta(n)).isoformat() for n in range((last - first).days + 1)}


def test_quoting(spark):
    df = spark.createDataFrame([("1",)], "`a.b``c` string")
    assert df.select(p.positive_number(p.quoted("a.b`c")).alias("f")).first().f is True


def test_conversions(texts):
    df = texts(["n", "d"], [("04195", "2024-02-29"), ("3.50", "2023-02-30"), ("x", "2023-1-1"), (None, None), ("9" * 400, " 2023-01-01")])
    got = df.select(p.to_number(F.col("n")), p.to_iso_date(F.col("d")).cast("string")).collect()
    assert [tuple(r) for r in got] == [
        (4195.0, "2024-02-29"),
        (3.5, None),
        (None, None),
        (None, None),
        (float("inf"), None),
    ]

"""Every registered query against its SQL counterpart in DuckDB."""

import datetime
import importlib.util
import os
from collections import Counter

import duckdb
import pytest

from tests.conftest import ROOT

SF_DIR = os.environ.get("SIEVELINE_SF_DIR", "/root/testdata/sf0.01")
spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
entry_module = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry_module)
from sieveline.acceptance.oracles import ORACLES  # noqa: E402
from sieveline.acceptance.queries import QUERIES  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in ("orders", "customer", "lineitem", "supplier", "part"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def canonical(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(canonical(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry_module.queries().items()
    assert ORACLES.items() <= entry_module.oracle_sql().items()


# Types that hold the same values: (Spark, DuckDB).
SAME_TYPES = {
    ("string", "VARCHAR"),
    ("int", "INTEGER"),
    ("bigint", "BIGINT"),
    ("double", "DOUBLE"),
    ("date", "DATE"),
    ("boolean", "BOOLEAN"),
    ("timestamp", "TIMESTAMP"),
}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    want_types = {row[0]: row[1] for row in duck.execute(f"DESCRIBE {ORACLES[name]}").fetchall()}
    for column, dtype in df.dtypes:
        assert (dtype, want_types[column]) in SAME_TYPES, column

    got_columns, got = rows_of(df.columns, df.collect())
    result = duck.execute(ORACLES[name])
    want_columns, want = rows_of([d[0] for d in result.description], result.fetchall())
    assert got_columns == want_columns
    assert sum(want.values()) > 0
    assert got == want


def test_entry_is_the_good_rows(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["ID_PER", "order_id", "amount", "order_dt", "cust_code", "email", "priority", "DINS"]
    assert df.count() > 0

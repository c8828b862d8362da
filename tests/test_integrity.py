"""Foreign keys: same flags on every route, no multiplied rows, no hot task."""

import pytest
from pyspark.sql import functions as F

from sieveline import clean, metrics, parse_rules, tag_and_flag, with_foreign_key
from sieveline.operators import integrity

# The parent fixture needs 327 bytes, the values a feed lacks or has may need less.
ROUTES = [
    pytest.param(dict(), id="broadcast"),
    pytest.param(dict(broadcast_bytes=300), id="listed"),
    pytest.param(dict(broadcast_bytes=0), id="shuffle"),
    pytest.param(dict(broadcast_bytes=0, hot_rows=3), id="hot"),
    pytest.param(dict(broadcast_bytes=0, hot_rows=0), id="all-hot"),
]


@pytest.fixture
def parent(spark):
    """Repeated keys, a NULL and a type other than text."""
    return spark.createDataFrame([(1,), (1,), (2,), (None,), (30,), (30,)], "`id.x` int")


@pytest.mark.parametrize("options", ROUTES)
def test_flags(texts, parent, options):
    values = ["1"] * 9 + ["2", "3", "01", None, None, "", "30", "9", "9", "9", "9", "9"]
    df = texts(["n", "k.v"], [(str(i), v) for i, v in enumerate(values)]).repartition(3)
    out = with_foreign_key(df, "k.v", parent, "id.x", "ok", **options)
    assert out.columns == ["n", "k.v", "ok"]
    want = {(str(i), v, v in {"1", "2", "30"}) for i, v in enumerate(values)}
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(values) and set(got) == want


@pytest.mark.parametrize("options", ROUTES)
def test_feed_values_of_another_type(spark, parent, options):
    df = spark.range(40).select((F.col("id") % 4).cast("short").alias("k"))
    out = with_foreign_key(df, "k", parent, "id.x", "ok", **options)
    assert out.dtypes == [("k", "smallint"), ("ok", "boolean")]
    assert {tuple(r) for r in out.distinct().collect()} == {(0, False), (1, True), (2, True), (3, False)}


@pytest.mark.parametrize("options", ROUTES)
def test_empty_sides(texts, parent, options):
    keys = parent.where("false")
    out = with_foreign_key(texts(["k"], [("1",), (None,)]), "k", keys, "id.x", "ok", **options)
    assert [r.ok for r in out.collect()] == [False, False]
    assert with_foreign_key(texts(["k"], []), "k", parent, "id.x", "ok", **options).count() == 0


@pytest.mark.parametrize("options", ROUTES)
def test_names_of_helper_columns(texts, options):
    columns = ["__key", "__found", "__hot", "__value", "__bucket", "__hash", "__hot_key", "__hot_found", "key"]
    df = texts(columns, [tuple("abcdefghi")] * 5)
    for column in ("__key", "__hot", "key"):
        out = with_foreign_key(df, column, df, "__hot", "ok", **options)
        assert out.columns == [*columns, "ok"]
        assert [r.ok for r in out.collect()] == [column == "__hot"] * 5


def test_existing_flag_name(texts, parent):
    with pytest.raises(ValueError, match="already exists"):
        with_foreign_key(texts(["k"], []), "k", parent, "id.x", "k")


def test_sizes_are_upper_bounds(parent):
    keys = integrity.parent_keys(parent, "id.x")
    sizes = integrity._sizes({3: keys, 5: keys.where("key = '30'"), 6: keys.where("false")})
    assert sizes == {3: 7 + 5 * integrity.ROW_OVERHEAD, 5: 2 * (2 + integrity.ROW_OVERHEAD), 6: 0}


def test_repeated_parent_keys_count_once(texts, spark):
    """A parent of many rows and few keys is small."""
    parent = spark.range(10_000).selectExpr("id % 3 AS id")
    key = integrity.ForeignKey("k", parent, "id", "ok")
    (lookup,) = integrity.measure(texts(["k"], [("1",)]), [key], 3 * (1 + integrity.ROW_OVERHEAD), 10)
    assert lookup.listed is not None and lookup.listed_means and lookup.listed.count() == 3


def test_one_bound_for_all_lists(texts, spark):
    """Three parents that each fit the bound, of which it holds one."""
    parent = spark.range(100)
    keys = [integrity.ForeignKey(c, parent, "id", f"ok_{c}") for c in "abc"]
    df = texts(["a", "b", "c"], [("1", "200", "x")] * 5)
    bound = 150 * (2 + integrity.ROW_OVERHEAD)
    lookups = integrity.measure(df, keys, bound, 10)
    assert sum(x.listed.agg(F.sum(integrity.broadcast_cost())).first()[0] or 0 for x in lookups if x.listed is not None) <= bound
    out = integrity.with_foreign_keys(df, keys, broadcast_bytes=bound)
    assert {tuple(r) for r in out.collect()} == {("1", "200", "x", True, False, False)}


@pytest.mark.parametrize("shared", [True, False])
def test_judged_values(texts, parent, monkeypatch, shared):
    if not shared:
        monkeypatch.setattr(integrity, "has_shared_folder", lambda df: False)
    df = texts(["k"], [("1",)] * 5 + [("9",)] * 2 + [(None,)] * 3 + [("30",)])
    judged = integrity.judged_values(df, {4: "k"}, {4: integrity.parent_keys(parent, "id.x")})
    assert {tuple(r) for r in judged.collect()} == {(4, "1", 5, True), (4, "9", 2, False), (4, "30", 1, True)}
    out = with_foreign_key(df, "k", parent, "id.x", "ok", broadcast_bytes=0, hot_rows=2)
    assert out.where("ok").count() == 6 and out.count() == 11


@pytest.mark.parametrize("shared", [True, False])
def test_every_key_is_measured_on_the_source(spark, texts, monkeypatch, shared):
    """Three keys on the shuffled way: one measuring job with one join for all."""
    if not shared:
        monkeypatch.setattr(integrity, "has_shared_folder", lambda df: False)
    plans = []
    real = integrity.judged_values

    def judged(df, columns, sets):
        assert df is source
        out = real(df, columns, sets)
        plans.append(out._jdf.queryExecution().optimizedPlan().toString())
        return out

    monkeypatch.setattr(integrity, "judged_values", judged)
    source = texts(["a", "b", "c"], [("1", "2", "3"), ("4", "5", None)])
    keys = [integrity.ForeignKey(c, spark.range(n), "id", f"ok_{c}") for c, n in (("a", 2), ("b", 4), ("c", 9))]
    out = integrity.with_foreign_keys(source, keys, broadcast_bytes=0, hot_rows=0)
    assert sorted(tuple(r) for r in out.collect()) == [
        ("1", "2", "3", True, True, True),
        ("4", "5", None, False, False, False),
    ]
    assert len(plans) == 1 and plans[0].count("Join") == (0 if shared else 1)


def test_hot_hashes_have_no_bound_on_length_or_number(spark):
    rows = [("a", 40, True), ("b", 30, False), ("c" * 3000, 30, True), ("d", 1, True)]
    values = spark.createDataFrame(rows, "key string, rows long, found boolean")
    assert integrity.hot_hashes(values, 20).count() == 3
    assert integrity.hot_hashes(values, 30).count() == 1


def test_long_hot_value_is_spread(spark):
    """Half the rows have one value of 300 bytes: no join task gets twice the mean."""
    rows = spark.range(0, 80_000, numPartitions=16)
    value = F.when(F.col("id") % 2 == 0, F.lpad(F.lit("7"), 300, "x")).otherwise(F.col("id").cast("string"))
    df = rows.select("id", value.alias("k"))
    parent = df.select("k").distinct().where(F.length("k") > 4)
    for key, setting in SPREAD.items():
        spark.conf.set(key, setting)
    try:
        out = with_foreign_key(df, "k", parent, "k", "ok", broadcast_bytes=0, hot_rows=1000)
        plan = out._jdf.queryExecution().executedPlan().toString()
        by_task = out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.count_if("ok").alias("ok")).collect()
    finally:
        for key in SPREAD:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert "TakeOrderedAndProject" not in plan
    assert sum(r.n for r in by_task) == 80_000 and sum(r.ok for r in by_task) == 40_000 + 35_000
    assert max(r.n for r in by_task) <= 2 * 80_000 / 8


SPREAD = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}


def test_hot_and_null_rows_are_spread(spark):
    """A third of the rows with one value, a third NULL: no join task gets them all."""
    rows = spark.range(0, 90_000, numPartitions=30)
    text = F.col("id").cast("string")
    df = rows.select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, text).alias("k"))
    parent = spark.createDataFrame([("hot",)], "k string")
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        out = with_foreign_key(df, "k", parent, "k", "ok", broadcast_bytes=0, hot_rows=1000)
        by_task = out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n"), F.count_if("ok").alias("ok"))
        by_task = by_task.collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert len(by_task) == 16 and sum(r.n for r in by_task) == 90_000 and sum(r.ok for r in by_task) == 30_000
    assert max(r.n for r in by_task) < 90_000 / 4


def test_clean_and_metrics_share_one_measuring(texts, parent, monkeypatch):
    calls, real = [], integrity.measure
    monkeypatch.setattr(integrity, "measure", lambda *args: calls.append(1) or real(*args))
    rules = parse_rules({"k": {"type": "foreign_key", "parent": "p", "parent_column": "id.x"}})
    df = texts(["k"], [("1",), ("9",), (None,)])
    flagged = tag_and_flag(df, rules, 202501, {"p": parent})
    assert clean(df, rules, 202501, flagged=flagged).good.count() == 1
    counts = {r.metric: r.rows_ok for r in metrics(df, rules, flagged=flagged).collect()}
    assert counts == {"raw": 3, "good": 1, "rejects": 2, "passed:k": 1} and len(calls) == 1


def test_rule_in_a_rule_set(spark, texts, parent):
    rules = parse_rules(
        {
            "unit": [
                {"type": "positive_number"},
                {"type": "foreign_key", "parent": "units", "parent_column": "id.x"},
            ],
            "boss": {"type": "foreign_key", "parent": "staff", "parent_column": "code"},
        }
    )
    staff = spark.createDataFrame([("A",), ("A",)], "code string")
    df = texts(["unit", "boss"], [("1", "A"), ("1", "B"), ("7", "A"), ("x", "A"), (None, "A"), ("2", None), ("30", "A")])
    parents = {"units": parent, "staff": staff}
    result = clean(df, rules, 1, parents=parents)
    assert result.good.columns == ["ID_PER", "unit", "boss", "DINS"]
    assert sorted((r.unit, r.boss) for r in result.good.collect()) == [(1.0, "A"), (30.0, "A")]
    assert result.rejects.count() == 5
    counts = {r.metric: r.rows_ok for r in metrics(df, rules, parents=parents).collect()}
    assert counts == {"raw": 7, "good": 2, "rejects": 5, "passed:unit": 4, "passed:boss": 5}
    with pytest.raises(ValueError, match="no parent table 'units'"):
        clean(df, rules, 1)

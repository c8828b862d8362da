"""Publication: periods are replaced whole, others stay, failures change nothing."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameReader, DataFrameWriter

from sieveline import JdbcTarget, append_jdbc, clean, load_period, parse_rules, publish, read_table, replace_periods

RULES = parse_rules({"CODE": {"type": "string_length", "length": 1}, "N": {"type": "positive_number"}})


@pytest.fixture
def frame(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), "ID_PER int, CODE string, N double")

    return build


def content(spark, path):
    return sorted(tuple(r) for r in read_table(spark, path).collect())


def test_replace_one_period(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    assert replace_periods(frame((202501, "a", 1.0), (202502, "b", 2.0), (202502, "c", 3.0)), path, [202501, 202502]) == {
        202501: 1,
        202502: 2,
    }
    before = sorted((tmp_path / "t" / "ID_PER=202501").glob("*.parquet"))
    assert replace_periods(frame((202502, "d", 4.0)), path, [202502]) == {202502: 1}
    assert content(spark, path) == [(202501, "a", 1.0), (202502, "d", 4.0)]
    assert sorted((tmp_path / "t" / "ID_PER=202501").glob("*.parquet")) == before
    assert read_table(spark, path).dtypes == [("ID_PER", "int"), ("CODE", "string"), ("N", "double")]


def test_publishing_again_changes_nothing(spark, frame, tmp_path):
    path, df = str(tmp_path / "t"), frame((202501, "a", 1.0), (202502, "b", 2.0))
    for rebalance in (False, True, False):
        replace_periods(df, path, [202501, 202502], rebalance=rebalance)
        assert content(spark, path) == [(202501, "a", 1.0), (202502, "b", 2.0)]


def test_period_without_rows_is_emptied(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    replace_periods(frame((202501, "a", 1.0), (202502, "b", 2.0)), path, [202501, 202502])
    for nothing in (frame(), frame((202501, "x", 1.0)).where(F.col("N") > 5), frame((1, "x", 1.0)).where(F.lit(False))):
        assert replace_periods(nothing, path, [202502]) == {202502: 0}
        assert content(spark, path) == [(202501, "a", 1.0)]
    assert replace_periods(frame((202502, "c", 3.0)), path, [202502, 202503]) == {202502: 1, 202503: 0}
    assert content(spark, path) == [(202501, "a", 1.0), (202502, "c", 3.0)]


def test_first_publication_without_rows(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    replace_periods(frame(), path, [202501])
    assert content(spark, path) == []
    assert read_table(spark, path).dtypes == [("ID_PER", "int"), ("CODE", "string"), ("N", "double")]


@pytest.mark.parametrize("stray", [202503, None])
def test_rows_of_other_periods_fail_before_anything_is_replaced(spark, frame, tmp_path, stray):
    path = str(tmp_path / "t")
    replace_periods(frame((202501, "a", 1.0), (202503, "z", 9.0)), path, [202501, 202503])
    for periods in ([202501], [202501, 202502]):
        with pytest.raises(PySparkException, match="not to be replaced"):
            replace_periods(frame((202501, "new", 2.0), (stray, "b", 2.0)), path, periods)
        assert content(spark, path) == [(202501, "a", 1.0), (202503, "z", 9.0)]
    with pytest.raises(ValueError, match="no periods"):
        replace_periods(frame(), path, [])


def test_failed_job_keeps_the_old_rows(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    replace_periods(frame((202501, "a", 1.0)), path, [202501])
    broken = frame(*[(202501, str(i), float(i)) for i in range(100)]).repartition(4)
    broken = broken.withColumn("N", F.when(F.col("N") < 99, F.col("N")).otherwise(F.raise_error(F.lit("lost")).cast("double")))
    with pytest.raises(PySparkException, match="lost"):
        replace_periods(broken, path, [202501])
    assert content(spark, path) == [(202501, "a", 1.0)]
    assert [f.name for f in (tmp_path / "t").iterdir() if f.is_dir()] == ["ID_PER=202501"]


@pytest.mark.parametrize("periods", [24, 200])
def test_many_periods_are_counted_once(spark, tmp_path, monkeypatch, periods):
    """No counter per period in the plan of the write, and one collect for all."""
    import sieveline.sinks.partitions as module

    plans, reads = [], []
    real_write, real_count = module.write_partitions, module.rows_by_partition

    def write(df, path, *columns, **options):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return real_write(df, path, *columns, **options)

    def count(*args, **kwargs):
        reads.append(1)
        return real_count(*args, **kwargs)

    monkeypatch.setattr(module, "write_partitions", write)
    monkeypatch.setattr(module, "rows_by_partition", count)
    months = [200001 + 100 * (i // 12) + i % 12 for i in range(periods)]
    listed = F.array(*[F.lit(m) for m in months])
    df = spark.range(0, 5 * periods, numPartitions=4).select(F.get(listed, (F.col("id") % periods).cast("int")).alias("ID_PER"), "id")
    rows = replace_periods(df, str(tmp_path / "t"), months)
    assert rows == {m: 5 for m in months} and len(reads) == 1
    assert "count" not in plans[0] and "CollectMetrics" not in plans[0]
    assert read_table(spark, str(tmp_path / "t")).count() == 5 * periods


def test_another_layout_is_refused_before_writing(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    replace_periods(frame((202501, "a", 1.0)), path, [202501])
    files = sorted((tmp_path / "t").rglob("*.parquet"))
    wider = frame((202502, "b", 2.0)).withColumn("MORE", F.lit(1))
    text = frame((202502, "b", 2.0)).withColumn("N", F.lit("x"))
    for other in (wider, wider.drop("N", "MORE"), text):
        with pytest.raises(ValueError, match=r"stored: .*CODE.* new: .*CODE"):
            replace_periods(other, path, [202502])
    with pytest.raises(ValueError, match="'N' is string"):
        replace_periods(text, path, [202502], additive=True)
    with pytest.raises(ValueError, match="case only"):
        replace_periods(frame((202502, "b", 2.0)).withColumn("code", F.lit(1)), path, [202502], additive=True)
    assert sorted((tmp_path / "t").rglob("*.parquet")) == files
    assert content(spark, path) == [(202501, "a", 1.0)]


def test_additive_layout_keeps_every_column(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    replace_periods(frame((202501, "a", 1.0)), path, [202501])
    replace_periods(frame((202502, "b", 2.0)).drop("N").withColumn("MORE", F.lit("m")), path, [202502], additive=True)
    assert read_table(spark, path).columns == ["ID_PER", "CODE", "N", "MORE"]
    rows = sorted(tuple(r) for r in read_table(spark, path).collect())
    assert rows == [(202501, "a", 1.0, None), (202502, "b", None, "m")]


def test_table_without_a_layout_file_has_the_union_of_its_files(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    frame((202501, "a", 1.0)).write.partitionBy("ID_PER").parquet(path)
    frame((202502, "b", 2.0)).withColumn("MORE", F.lit("m")).write.mode("append").partitionBy("ID_PER").parquet(path)
    assert sorted(read_table(spark, path).columns) == ["CODE", "ID_PER", "MORE", "N"]
    replace_periods(frame((202501, "z", 1.0)), path, [202501], additive=True)
    assert {r.CODE for r in read_table(spark, path).collect()} == {"z", "b"}


def layouts(path):
    return sorted(f.name for f in path.glob("_layout*"))


def test_a_failed_first_publish_leaves_no_layout(spark, frame, tmp_path):
    """The corrected feed may have other types: there is no table yet to disagree with."""
    path = tmp_path / "t"
    stray = frame((202501, "a", 1.0), (202502, "b", 2.0))
    with pytest.raises(PySparkException, match="not to be replaced"):
        replace_periods(stray, str(path), [202501])
    assert layouts(path) == []
    corrected = frame((202501, "a", 1.0)).withColumn("N", F.lit("text"))
    assert replace_periods(corrected, str(path), [202501]) == {202501: 1}
    assert content(spark, str(path)) == [(202501, "a", "text")] and layouts(path) == ["_layout-000001.json"]


def test_a_failed_additive_publish_leaves_the_old_layout(spark, frame, tmp_path):
    path, old = tmp_path / "t", frame((202501, "a", 1.0))
    replace_periods(old, str(path), [202501])
    wider = frame((202502, "b", 2.0), (209901, "stray", 1.0)).withColumn("MORE", F.lit(1))
    with pytest.raises(PySparkException, match="not to be replaced"):
        replace_periods(wider, str(path), [202502], additive=True)
    assert replace_periods(frame((202501, "c", 3.0)), str(path), [202501]) == {202501: 1}
    assert read_table(spark, str(path)).columns == ["ID_PER", "CODE", "N"] and layouts(path) == ["_layout-000001.json"]
    replace_periods(wider.where("ID_PER = 202502"), str(path), [202502], additive=True)
    assert read_table(spark, str(path)).columns == ["ID_PER", "CODE", "N", "MORE"] and layouts(path) == ["_layout-000001.json", "_layout-000002.json"]
    with pytest.raises(ValueError, match="layout differs"):
        replace_periods(old, str(path), [202501])


def test_a_layout_not_stored_is_completed_by_running_again(spark, frame, tmp_path, monkeypatch):
    """A run that dies between the data's commit and the layout's: the table reads in the
    old layout until it runs again."""
    import sieveline.sinks.partitions as module

    path, wider = str(tmp_path / "t"), frame((202502, "b", 2.0)).withColumn("MORE", F.lit(1))
    replace_periods(frame((202501, "a", 1.0)), path, [202501])

    def dies(*args):
        raise OSError("gone")

    with monkeypatch.context() as broken:
        broken.setattr(module, "store_layout", dies)
        with pytest.raises(OSError, match="gone"):
            replace_periods(wider, path, [202502], additive=True)
    assert content(spark, path) == [(202501, "a", 1.0), (202502, "b", 2.0)]
    replace_periods(wider, path, [202502], additive=True)
    assert content(spark, path) == [(202501, "a", 1.0, None), (202502, "b", 2.0, 1)]


def test_an_unversioned_layout_is_the_first_version(spark, frame, tmp_path):
    path = tmp_path / "t"
    replace_periods(frame((202501, "a", 1.0)), str(path), [202501])
    (path / "_layout-000001.json").rename(path / "_layout.json")
    with pytest.raises(ValueError, match="layout differs"):
        replace_periods(frame((202502, "b", 2.0)).drop("N"), str(path), [202502])
    replace_periods(frame((202502, "b", 2.0)).withColumn("MORE", F.lit("m")), str(path), [202502], additive=True)
    assert layouts(path) == ["_layout-000001.json", "_layout.json"]
    assert content(spark, str(path)) == [(202501, "a", 1.0, None), (202502, "b", 2.0, "m")]


@pytest.mark.parametrize("rebalance", [False, True])
def test_emptied_periods_are_in_the_one_commit(spark, frame, tmp_path, monkeypatch, rebalance):
    """Nothing is written behind the commit, so a failure cannot leave old rows in a period
    that is to be empty."""
    import sieveline.sinks.partitions as module

    path, commits = str(tmp_path / "t"), []
    replace_periods(frame((202501, "a", 1.0), (202502, "b", 2.0)), path, [202501, 202502])
    real = module.write_partitions
    monkeypatch.setattr(module, "write_partitions", lambda *a, **k: commits.append(a) or real(*a, **k))
    monkeypatch.setattr(module, "store_layout", lambda *a: content(spark, path) == [(202501, "c", 3.0)] or pytest.fail("emptied later"))
    assert replace_periods(frame((202501, "c", 3.0)), path, [202501, 202502, 202503], rebalance=rebalance) == {202501: 1, 202502: 0, 202503: 0}
    assert len(commits) == 1 and content(spark, path) == [(202501, "c", 3.0)]
    with pytest.raises(ValueError, match="_mark"):
        replace_periods(frame((202501, "c", 3.0)).withColumn("_mark", F.lit(True)), path, [202501])


def test_large_period_is_split_when_rebalanced(spark, tmp_path):
    df = spark.range(0, 200_000, numPartitions=16).select(
        F.when(F.col("id") % 10 < 9, 202501).otherwise(202502).alias("ID_PER"), F.sha2(F.col("id").cast("string"), 256).alias("H")
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        replace_periods(df, str(tmp_path / "t"), [202501, 202502], rebalance=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {p: len(list((tmp_path / "t" / f"ID_PER={p}").glob("*.parquet"))) for p in (202501, 202502)}
    assert files[202501] > 1 and sum(files.values()) < 32
    assert read_table(spark, str(tmp_path / "t")).count() == 200_000


FEED = [("m", "01", "a"), ("m", "2", "bb"), ("m", "x", "c")]


@pytest.mark.parametrize("rebalance", [False, True])
def test_publish_stores_good_rows_and_rejects_in_one_pass(spark, texts, tmp_path, rebalance):
    path = str(tmp_path / "t")
    cleaned = clean(texts(["MORE", "N", "CODE"], FEED), RULES, 202501)
    assert publish(cleaned, RULES, path, [202501], rebalance=rebalance) == {202501: 1}
    assert read_table(spark, path).columns == ["ID_PER", "CODE", "N"]
    assert content(spark, path) == [(202501, "a", 1.0)]
    stored = read_table(spark, path, kind="rejects")
    assert stored.columns == ["ID_PER", "MORE", "N", "CODE", "DINS"]
    assert sorted(tuple(r)[:-1] for r in stored.collect()) == [(202501, "m", "2", "bb"), (202501, "m", "x", "c")]


def test_either_kind_is_emptied_by_the_same_commit(spark, texts, tmp_path):
    path, columns = str(tmp_path / "t"), ["MORE", "N", "CODE"]
    publish(clean(texts(columns, FEED), RULES, 202501), RULES, path, [202501])
    publish(clean(texts(columns, FEED), RULES, 202502), RULES, path, [202502])
    assert publish(clean(texts(columns, FEED[1:]), RULES, 202502), RULES, path, [202502, 202503]) == {202502: 0, 202503: 0}
    assert content(spark, path) == [(202501, "a", 1.0)]
    publish(clean(texts(columns, FEED[:1]), RULES, 202501), RULES, path, [202501])
    assert {r.ID_PER for r in read_table(spark, path, kind="rejects").collect()} == {202502}


def test_failure_leaves_both_kinds(spark, texts, tmp_path):
    path, columns = str(tmp_path / "t"), ["MORE", "N", "CODE"]
    publish(clean(texts(columns, FEED), RULES, 202501), RULES, path, [202501])
    before = sorted((tmp_path / "t").rglob("*.parquet"))
    broken = texts(columns, FEED * 30).repartition(4)
    broken = broken.withColumn("MORE", F.when(F.col("N") != "x", F.col("MORE")).otherwise(F.raise_error(F.lit("lost"))))
    with pytest.raises(PySparkException, match="lost"):
        publish(clean(broken, RULES, 202501), RULES, path, [202501])
    assert sorted((tmp_path / "t").rglob("*.parquet")) == before
    assert content(spark, path) == [(202501, "a", 1.0)] and read_table(spark, path, kind="rejects").count() == 2


def test_rejects_of_another_layout(spark, texts, tmp_path):
    path = str(tmp_path / "t")
    publish(clean(texts(["MORE", "N", "CODE"], FEED), RULES, 202501), RULES, path, [202501])
    wider = clean(texts(["MORE", "N", "CODE", "NEW"], [(*r, "n") for r in FEED]), RULES, 202502)
    with pytest.raises(ValueError, match="rejects: layout differs"):
        publish(wider, RULES, path, [202502])
    publish(wider, RULES, path, [202502], additive=True)
    assert {(r.ID_PER, r.NEW) for r in read_table(spark, path, kind="rejects").collect()} == {(202501, None), (202502, "n")}
    with pytest.raises(ValueError, match="stored"):
        replace_periods(texts(["CODE"], []).withColumn("ID_PER", F.lit(1)), path, [202501])


def test_publish_renames_and_checks_before_writing(spark, texts, tmp_path):
    path = str(tmp_path / "good")
    good = clean(texts(["N", "ACR"], [("1", "a")]), parse_rules({"N": {"type": "positive_number"}}), 202501).good
    with pytest.raises(ValueError, match="missing"):
        publish(good, RULES, path, [202501])
    assert not (tmp_path / "good").exists()
    publish(good, RULES, path, [202501], rename={"ACR": "CODE"})
    assert content(spark, path) == [(202501, "a", 1.0)]


class FakeDatabase:
    """Stands in for Spark's JDBC source: records options, holds rows in a list."""

    def __init__(self, spark, monkeypatch, lost_report=False):
        self.rows, self.writes, self.reads = [], [], []
        real_save, real_load = DataFrameWriter.save, DataFrameReader.load
        real_option, real_mode = DataFrameWriter.option, DataFrameWriter.mode
        real_read_option = DataFrameReader.option
        formats, options = {}, {}

        def set_format(target, name):
            formats[id(target)] = name
            return target

        def set_option(target, key, value):
            options.setdefault(id(target), {})[key] = value
            if isinstance(target, DataFrameWriter):
                return real_option(target, key, value)
            return target if formats.get(id(target)) == "jdbc" else real_read_option(target, key, value)

        def set_options(target, **values):
            options.setdefault(id(target), {}).update(values)
            return target

        def set_mode(target, mode):
            options.setdefault(id(target), {})["mode"] = mode
            return real_mode(target, mode)

        def save(writer, *args, **kwargs):
            if formats.get(id(writer)) != "jdbc":
                return real_save(writer, *args, **kwargs)
            self.writes.append(options.pop(id(writer)))
            rows = [tuple(r) for r in writer._df.collect()]
            self.rows += rows * (2 if lost_report else 1)

        def load(reader, *args, **kwargs):
            if formats.get(id(reader)) != "jdbc":
                return real_load(reader, *args, **kwargs)
            self.reads.append(options.pop(id(reader)))
            period = int(self.reads[-1]["query"].rsplit("=", 1)[1])
            return spark.createDataFrame([(sum(r[0] == period for r in self.rows),)], "N long")

        for cls in (DataFrameWriter, DataFrameReader):
            monkeypatch.setattr(cls, "format", set_format)
            monkeypatch.setattr(cls, "option", set_option)
            monkeypatch.setattr(cls, "options", set_options)
        monkeypatch.setattr(DataFrameWriter, "mode", set_mode)
        monkeypatch.setattr(DataFrameWriter, "save", save)
        monkeypatch.setattr(DataFrameReader, "load", load)


def test_jdbc_append_options(spark, frame, monkeypatch):
    db = FakeDatabase(spark, monkeypatch)
    append_jdbc(frame((1, "a", 1.0)), "jdbc:x", "T", batchsize=5, connections=2, options={"user": "u", "driver": "d"})
    assert db.writes == [
        {"user": "u", "driver": "d", "url": "jdbc:x", "dbtable": "T", "batchsize": 5, "numPartitions": 2, "mode": "append"}
    ]
    assert db.rows == [(1, "a", 1.0)]


def test_jdbc_load_of_a_period(spark, frame, monkeypatch):
    db = FakeDatabase(spark, monkeypatch)
    df = frame((202501, "a", 1.0), (202501, "b", 2.0))
    assert load_period(df, "jdbc:x", "T", 202501, options={"user": "u"}) == 2
    assert [r["query"] for r in db.reads] == ["SELECT COUNT(*) AS N FROM T WHERE ID_PER = 202501"] * 2
    with pytest.raises(ValueError, match="already has 2 rows"):
        load_period(df, "jdbc:x", "T", 202501)
    assert len(db.rows) == 2


def test_jdbc_load_reports_rows_inserted_twice(spark, frame, monkeypatch):
    FakeDatabase(spark, monkeypatch, lost_report=True)
    with pytest.raises(RuntimeError, match="has 2 rows instead of 1"):
        load_period(frame((202501, "a", 1.0)), "jdbc:x", "T", 202501)


def test_publish_loads_the_database_from_the_table(spark, frame, tmp_path, monkeypatch):
    import sieveline.sinks.publish as module

    calls = []

    def load(df, url, table, period, **options):
        calls.append((url, table, period, options["batchsize"], options["connections"], dict(options["options"])))
        assert str(tmp_path) in "".join(df.inputFiles())
        return df.count()

    monkeypatch.setattr(module, "load_period", load)
    monkeypatch.setattr(module, "check_empty", lambda spark, url, table, period, **where: None)
    target = JdbcTarget("jdbc:x", "T", {"password": "secret"}, connections=3)
    publish(frame((202501, "a", 1.0), (202502, "b", 1.0)), RULES, str(tmp_path / "t"), [202502, 202501], jdbc=target)
    assert calls == [("jdbc:x", "T", p, 10_000, 3, {"password": "secret"}) for p in (202501, 202502)]
    assert "secret" not in repr(target)


def test_refused_load_leaves_the_table_unchanged(spark, frame, tmp_path, monkeypatch):
    """The second period has rows in the database: nothing is written anywhere."""
    path = str(tmp_path / "t")
    publish(frame((202501, "a", 1.0), (202502, "b", 1.0)), RULES, path, [202501, 202502])
    db = FakeDatabase(spark, monkeypatch)
    db.rows.append((202502, "old", 1.0))
    with pytest.raises(ValueError, match="period 202502 already has 1 rows"):
        publish(frame((202501, "x", 2.0), (202502, "y", 2.0)), RULES, path, [202501, 202502], jdbc=JdbcTarget("jdbc:x", "T"))
    assert content(spark, path) == [(202501, "a", 1.0), (202502, "b", 1.0)] and db.rows == [(202502, "old", 1.0)]


def test_second_publication_empties_the_period(spark, frame, tmp_path, monkeypatch):
    path, db = str(tmp_path / "t"), FakeDatabase(spark, monkeypatch)

    def empty(period):
        db.rows = [r for r in db.rows if r[0] != period]

    target = JdbcTarget("jdbc:x", "T", empty_period=empty)
    for n in (1.0, 2.0):
        assert publish(frame((202501, "a", n)), RULES, path, [202501], jdbc=target) == {202501: 1}
        assert db.rows == [(202501, "a", n)]


def test_a_failing_empty_leaves_the_table(spark, frame, tmp_path, monkeypatch):
    """All periods are emptied and checked before the table is touched."""
    path, db, emptied = str(tmp_path / "t"), FakeDatabase(spark, monkeypatch), []
    publish(frame((202501, "a", 1.0), (202502, "b", 1.0)), RULES, path, [202501, 202502])
    files = sorted((tmp_path / "t").rglob("*.parquet"))
    new = frame((202501, "x", 2.0), (202502, "y", 2.0))

    def refuses(period):
        emptied.append(period)
        if period == 202502:
            raise PermissionError("not allowed")

    with pytest.raises(PermissionError):
        publish(new, RULES, path, [202501, 202502], jdbc=JdbcTarget("jdbc:x", "T", empty_period=refuses))
    assert emptied == [202501, 202502]
    db.rows.append((202502, "old", 1.0))
    with pytest.raises(ValueError, match="already has 1 rows"):  # a statement that empties nothing
        publish(new, RULES, path, [202501, 202502], jdbc=JdbcTarget("jdbc:x", "T", empty_period=lambda period: None))
    assert content(spark, path) == [(202501, "a", 1.0), (202502, "b", 1.0)] and sorted((tmp_path / "t").rglob("*.parquet")) == files
    assert db.rows == [(202502, "old", 1.0)]

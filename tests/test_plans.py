"""Plans: what must not be in them at scale."""

import os

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sieveline import clean, metrics, read_feed, read_table, replace_periods, with_foreign_key
from sieveline.acceptance.feeds import ORDER_COLUMNS, dirty_orders
from sieveline.acceptance.queries import QUERIES, RULES
from sieveline import delete_folder, new_folder

SF_DIR = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def feed(spark, tmp_path):
    path = tmp_path / "202501_orders.csv"
    path.write_text("order_id,amount,order_dt,cust_code,email,priority,more\n1,2,2024-01-01,0000000000000001,a@b.it,LOW,x\n")
    return read_feed(spark, str(path), [*ORDER_COLUMNS, "more"])


def test_cleaning_does_not_shuffle(feed):
    for df in clean(feed, RULES, 202501):
        text = plan(df)
        assert "Exchange" not in text and "Join" not in text and "Python" not in text
        assert text.count("FileScan csv") == 1


def test_metrics_are_one_scan_and_exchange_only_counters(feed):
    text = plan(metrics(feed, RULES)).split("Initial Plan")[-1]
    assert text.count("FileScan csv") == 1 and text.count("Exchange") == 1
    assert text.index("partial_count") > text.index("Exchange SinglePartition")
    # Columns without a rule are not even parsed, and each pattern is matched once.
    assert "more" not in text and "order_id" not in text
    assert text.count("RLIKE(amount") == 1 and text.count("RLIKE(email") == 1


def test_metrics_and_good_rows_in_one_job(spark, feed, tmp_path):
    spark.sparkContext.setJobGroup("publish", "")
    seen = Observation()
    good = clean(feed, RULES, 202501, observation=seen).good
    assert replace_periods(good, str(tmp_path / "t"), [202501]) == {202501: 1}
    assert seen.get["good"] == 1
    # The write, and the count of the files' footers after its commit.
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("publish")) <= 3
    spark.sparkContext.setJobGroup("", "")


def test_validated_dates_are_matched_once(feed):
    work = plan(clean(feed, RULES, 202501).good).split("FileScan")[0]
    assert work.count("RLIKE(order_dt") == 1


def test_periods_are_pruned(spark, feed, tmp_path):
    replace_periods(clean(feed, RULES, 202501).good, str(tmp_path / "t"), [202501])
    text = plan(read_table(spark, str(tmp_path / "t")).where(F.col("ID_PER") == 202502))
    assert "PartitionFilters: [isnotnull(ID_PER" in text


def feed_side(text):
    """The part of a join's plan that reads the feed."""
    assert text.count("FileScan csv") >= 1
    text = text.split("Initial Plan")[-1]
    return text[text.index("Join") : text.index("FileScan csv")]


def test_small_parent_leaves_the_feed_in_place(spark, feed):
    text = plan(with_foreign_key(feed, "cust_code", spark.range(3), "id", "ok"))
    assert "LeftOuter, BuildRight" in text and "Exchange" not in feed_side(text)


@pytest.mark.parametrize("known", [0, 1], ids=["all missing", "none missing"])
def test_short_list_leaves_the_feed_in_place(spark, feed, known):
    """The parent is large, but what it lacks (or has) of the feed is little."""
    parent = spark.range(50).selectExpr(f"if(id < {known}, '0000000000000001', id) AS id")
    text = plan(with_foreign_key(feed, "cust_code", parent, "id", "ok", broadcast_bytes=100))
    assert "LeftOuter, BuildRight" in text and "Exchange" not in feed_side(text)


def test_long_lists_are_not_broadcast(spark, tmp_path):
    path = tmp_path / "f.csv"
    path.write_text("k,v\n1,a\n2,b\n99,c\n98,d\n")
    feed = read_feed(spark, str(path), ["k", "v"])
    text = plan(with_foreign_key(feed, "k", spark.range(50), "id", "ok", broadcast_bytes=100)).split("Initial Plan")[-1]
    assert text.count("HashJoin [__value") == 1 and "BroadcastHashJoin [__value" not in text
    assert text.count("CartesianProduct") == text.count("NestedLoop") == 0
    assert "TakeOrderedAndProject" not in text and "Limit" not in text


def test_publishing_both_kinds_scans_the_feed_once(spark, feed):
    text = plan(clean(feed, RULES, 202501).both)
    assert text.count("FileScan csv") == 1 and "Exchange" not in text


@needs_data
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_any_query(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "Python" not in text and "Pandas" not in text and "CartesianProduct" not in text


@needs_data
def test_parquet_columns_are_pruned(spark):
    text = plan(dirty_orders(spark, SF_DIR).select("priority"))
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in text


class FakeSession:
    """A session whose conf or context names a shared folder, or neither."""

    def __init__(self, conf=None, context=None):
        self.conf, self.sparkContext = self, self
        self.named, self.context = conf, context

    def get(self, key, default):
        assert key == "spark.checkpoint.dir"
        return self.named or default

    def getCheckpointDir(self):
        return self.context


def test_folders_are_in_the_shared_one():
    for session in (FakeSession("hdfs://n/shared/"), FakeSession(context="hdfs://n/shared")):
        first, second = new_folder(session, "x"), new_folder(session, "x")
        assert first.startswith("hdfs://n/shared/sieveline/x-") and first != second


def test_folders_are_never_local():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        new_folder(FakeSession(), "x")


def test_a_run_can_delete_its_folder(spark):
    folder = new_folder(spark, "gone")
    spark.range(3).write.parquet(folder)
    assert delete_folder(spark, folder) and not delete_folder(spark, folder)
    with pytest.raises(ValueError, match="not a folder of this library"):
        delete_folder(spark, "/somewhere/else")

"""One query per operator, over the whole tables. DINS is a fixed instant."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.acceptance.feeds import (
    ORDER_COLUMNS,
    ORDERS_CONFIG,
    PERIODS,
    dirty_customers,
    dirty_orders,
    dirty_orders_by_period,
    table,
    write_deliveries,
)
from sieveline.functions import predicates as p
from sieveline.operators.clean import clean
from sieveline.operators.combine import filter_equals, union_feeds
from sieveline.operators.integrity import ForeignKey, with_foreign_key, with_foreign_keys
from sieveline.operators.metrics import metrics
from sieveline.operators.target import to_target
from sieveline.operators.validate import row_validity, with_flags
from sieveline.plans.feed import process_feed
from sieveline.plans.ruleset import feed_rules, parse_rules
from sieveline.shared import new_folder
from sieveline.sinks.partitions import read_table, replace_periods
from sieveline.sinks.publish import publish
from sieveline.sources.csv_feed import file_period, read_feed

Query = Callable[[SparkSession, str], DataFrame]

RUN = 7
INGESTED_AT = datetime(2025, 2, 1, 12, 0, tzinfo=timezone.utc)
RULES = feed_rules(ORDERS_CONFIG, "orders")


def csv_scan_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "csv_scan")
    dirty_orders(spark, sf_dir).write.option("header", True).csv(folder)
    return read_feed(spark, folder, ORDER_COLUMNS)


def period_from_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_deliveries(spark, sf_dir, new_folder(spark, "deliveries"))
    feed = read_feed(spark, files, ORDER_COLUMNS)
    return feed.select(file_period(check_month=True).alias("ID_PER")).groupBy("ID_PER").agg(F.count("*").alias("rows"))


def _rule(column: str, predicate: Callable[[Column], Column]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return dirty_orders(spark, sf_dir).select("order_id", predicate(p.quoted(column)).alias("flag"))

    return query


def rule_is_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unsigned number test on customers' balances, some of them negative."""
    return dirty_customers(spark, sf_dir).select("customer_id", p.is_number(F.col("balance")).alias("flag"))


def rule_skip_and_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = parse_rules(
        {
            "amount": {"type": "positive_number"},
            "order_dt": {"type": "date"},
            "priority": {"type": "string", "skip_validation": True},
            "warehouse": {"type": "string_length", "length": 3},
        }
    )
    feed, flags = with_flags(dirty_orders(spark, sf_dir), rules)
    return feed.select("order_id", row_validity(flags).alias("valid"))


def clean_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(dirty_orders(spark, sf_dir), RULES, RUN, INGESTED_AT).good


def clean_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(dirty_orders(spark, sf_dir), RULES, RUN, INGESTED_AT).rejects


def skipped_conversion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unchecked columns are converted all the same; what does not convert is NULL."""
    rules = parse_rules(
        {
            "amount": {"type": "positive_number", "skip_validation": True},
            "order_dt": {"type": "date", "skip_validation": True},
            "cust_code": {"type": "string_length", "length": 16},
        }
    )
    return clean(dirty_orders(spark, sf_dir), rules, RUN, INGESTED_AT, period_name="IDRUN").good


def feed_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole feed run on CSV files of two periods."""
    files = write_deliveries(spark, sf_dir, new_folder(spark, "deliveries"))
    return process_feed(spark, ORDERS_CONFIG, "orders", files, ingested_at=INGESTED_AT, columns=ORDER_COLUMNS).good


def feed_rejects_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_deliveries(spark, sf_dir, new_folder(spark, "deliveries"))
    return process_feed(spark, ORDERS_CONFIG, "orders", files, ingested_at=INGESTED_AT, columns=ORDER_COLUMNS).rejects


def metrics_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics(dirty_orders(spark, sf_dir), RULES).select("metric", F.col("rows_ok").alias("rows"))


def metrics_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    feed = dirty_orders_by_period(spark, sf_dir)
    return metrics(feed, RULES, F.col("delivery"))


def target_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = clean(dirty_orders(spark, sf_dir), RULES, RUN, INGESTED_AT, period_name="IDRUN").good
    layout = parse_rules(
        {"COD_ORD": {"type": "string", "skip_validation": True}, "amount": {"type": "positive_number"}}
    )
    return to_target(good, layout, {"IDRUN": "ID_PER", "order_id": "COD_ORD"})


def filter_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_equals(clean(dirty_orders(spark, sf_dir), RULES, RUN, INGESTED_AT).good, "priority", "LOW")


TARGET = parse_rules({"order_id": {"type": "string", "skip_validation": True}, **ORDERS_CONFIG["orders"]["columns"]})


def _publish_both(spark: SparkSession, sf_dir: str, path: str, rejects: bool = False) -> DataFrame:
    """First publication of both periods; returns the feed."""
    feed = dirty_orders_by_period(spark, sf_dir)
    cleaned = clean(feed, RULES, F.col("delivery"), INGESTED_AT)
    publish(cleaned if rejects else cleaned.good, TARGET, path, PERIODS)
    return feed


def partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both periods are published, then the second again with corrected
    priorities; the whole table."""
    path = new_folder(spark, "replace")
    feed = _publish_both(spark, sf_dir, path)
    second = feed.where(F.col("delivery") == PERIODS[1])
    corrected = second.withColumn("priority", F.regexp_replace("priority", "^[0-9]-", ""))
    publish(clean(corrected, RULES, PERIODS[1], INGESTED_AT).good, TARGET, path, [PERIODS[1]])
    return read_table(spark, path)


def partition_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second period is published again from a delivery without any good
    row, which empties it; the whole table."""
    path = new_folder(spark, "empty")
    feed = _publish_both(spark, sf_dir, path)
    broken = feed.where(F.col("delivery") == PERIODS[1]).withColumn("email", F.lit("none"))
    publish(clean(broken, RULES, PERIODS[1], INGESTED_AT).good, TARGET, path, [PERIODS[1]])
    return read_table(spark, path)


def rejects_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good rows and rejects are published in one pass; the rejects."""
    path = new_folder(spark, "rejects")
    _publish_both(spark, sf_dir, path, rejects=True)
    return read_table(spark, path, kind="rejects").drop("delivery", "DINS")


def partition_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders published by the month of their date, all months at once."""
    path = new_folder(spark, "months")
    month = F.date_format("o_orderdate", "yyyyMM").cast("int")
    orders = table(spark, sf_dir, "orders").select(month.alias("ID_PER"), "o_orderkey", "o_custkey")
    months = [r.ID_PER for r in orders.select("ID_PER").distinct().collect()]
    replace_periods(orders, path, months)
    return read_table(spark, path)


def partition_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second period has one more column than the first; the whole table."""
    path = new_folder(spark, "layouts")
    feed = dirty_orders_by_period(spark, sf_dir).withColumnRenamed("delivery", "ID_PER")
    first, second = (feed.where(F.col("ID_PER") == p) for p in PERIODS)
    replace_periods(first.drop("priority"), path, [PERIODS[0]])
    replace_periods(second, path, [PERIODS[1]], additive=True)
    return read_table(spark, path)


def union_of_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union_feeds({"orders": dirty_orders(spark, sf_dir), "customers": dirty_customers(spark, sf_dir)})


def multi_rule_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = parse_rules(
        {
            "amount": [{"type": "number"}, {"type": "non_negative"}],
            "cust_code": [{"type": "string_length", "length": 16}, {"type": "positive_number"}],
        }
    )
    feed, flags = with_flags(dirty_orders(spark, sf_dir), rules)
    return feed.select("order_id", row_validity(flags).alias("valid"))


def rule_signed_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number test and the value test apart."""
    amount = F.col("amount")
    return dirty_orders(spark, sf_dir).select(
        "order_id", p.number(amount).alias("is_number"), p.non_negative(amount).alias("is_non_negative")
    )


CUSTOMER_KEY = {"type": "foreign_key", "parent": "customers", "parent_column": "code"}


def _building_customers(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    customers = filter_equals(table(spark, sf_dir, "customer"), "c_mktsegment", "BUILDING")
    return {"customers": customers.selectExpr("lpad(CAST(c_custkey AS STRING), 16, '0') AS code")}


def foreign_key_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order customers against the customers of one segment, as a rule."""
    rules = parse_rules({"cust_code": CUSTOMER_KEY})
    feed, flags = with_flags(dirty_orders(spark, sf_dir), rules, _building_customers(spark, sf_dir))
    return feed.select("order_id", row_validity(flags).alias("valid"))


def foreign_key_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good rows when the customer also has to exist."""
    columns = ORDERS_CONFIG["orders"]["columns"]
    rules = parse_rules({**columns, "cust_code": [columns["cust_code"], CUSTOMER_KEY]})
    parents = _building_customers(spark, sf_dir)
    return clean(dirty_orders(spark, sf_dir), rules, RUN, INGESTED_AT, parents=parents).good


def foreign_key_few_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order customers against all but one nation's, with a parent above the
    broadcast bound and a short list of missing values."""
    customers = table(spark, sf_dir, "customer").where(F.col("c_nationkey") != 7)
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "CAST(o_custkey AS STRING) AS customer")
    return with_foreign_key(orders, "customer", customers, "c_custkey", "valid", broadcast_bytes=50_000)


def foreign_key_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line item suppliers against some suppliers, without broadcasting any list;
    suppliers with many lines go the way of hot values."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("l_suppkey").cast("string")).alias("supplier"),
    )
    suppliers = table(spark, sf_dir, "supplier").where(F.col("s_nationkey") < 12)
    return with_foreign_key(lines, "supplier", suppliers, "s_suppkey", "valid", broadcast_bytes=0, hot_rows=500)


def foreign_key_long_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line item suppliers as texts of 300 bytes, against some suppliers, on the
    shuffled way; many of them are hot."""
    code = "lpad(CAST({} AS STRING), 300, '0')"
    lines = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey", "l_linenumber", f"{code.format('l_suppkey')} AS supplier")
    suppliers = table(spark, sf_dir, "supplier").where(F.col("s_nationkey") < 12)
    parent = suppliers.selectExpr(f"{code.format('s_suppkey')} AS code")
    flagged = with_foreign_key(lines, "supplier", parent, "code", "valid", broadcast_bytes=0, hot_rows=500)
    return flagged.drop("supplier")


def foreign_key_several(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part, supplier and order of the line items, measured together."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    keys = [
        ForeignKey("l_partkey", table(spark, sf_dir, "part").where(F.col("p_partkey") % 3 != 0), "p_partkey", "part_ok"),
        ForeignKey("l_suppkey", table(spark, sf_dir, "supplier").where(F.col("s_nationkey") < 12), "s_suppkey", "supplier_ok"),
        ForeignKey("l_orderkey", table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "F"), "o_orderkey", "order_ok"),
    ]
    flagged = with_foreign_keys(lines, keys, broadcast_bytes=20_000, hot_rows=500)
    return flagged.select("l_orderkey", "l_linenumber", "part_ok", "supplier_ok", "order_ok")


QUERIES: dict[str, Query] = {
    "csv_scan_strings": csv_scan_strings,
    "period_from_filename": period_from_filename,
    "rule_non_negative_number": _rule("amount", p.positive_number),
    "rule_is_number": rule_is_number,
    "rule_no_digits": _rule("priority", p.string_no_numbers),
    "rule_iso_date": _rule("order_dt", p.iso_date),
    "rule_email": _rule("email", p.email),
    "rule_exact_length": _rule("cust_code", lambda c: p.string_length(c, 16)),
    "rule_signed_number": rule_signed_number,
    "rule_skip_and_missing": rule_skip_and_missing,
    "clean_good": clean_good,
    "clean_rejects": clean_rejects,
    "skipped_conversion": skipped_conversion,
    "feed_from_files": feed_from_files,
    "feed_rejects_from_files": feed_rejects_from_files,
    "metrics": metrics_total,
    "metrics_by_period": metrics_by_period,
    "target_projection": target_projection,
    "filter_equals": filter_priority,
    "partition_replace": partition_replace,
    "partition_empty": partition_empty,
    "partition_many": partition_many,
    "partition_layouts": partition_layouts,
    "rejects_published": rejects_published,
    "union_feeds": union_of_feeds,
    "multi_rule_column": multi_rule_column,
    "foreign_key_split": foreign_key_split,
    "foreign_key_clean": foreign_key_clean,
    "foreign_key_few_missing": foreign_key_few_missing,
    "foreign_key_shuffled": foreign_key_shuffled,
    "foreign_key_long_hot": foreign_key_long_hot,
    "foreign_key_several": foreign_key_several,
}

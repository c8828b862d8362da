"""Dirty text feeds derived from whole tables; the first matching case wins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER_COLUMNS = ["order_id", "amount", "order_dt", "cust_code", "email", "priority"]
ORDERS_CONFIG = {
    "orders": {
        "columns": {
            "amount": {"type": "positive_number"},
            "order_dt": {"type": "date", "format": "yyyy-MM-dd"},
            "cust_code": {"type": "string_length", "length": 16},
            "email": {"type": "email"},
            "priority": {"type": "string_no_numbers"},
        }
    }
}
# The two deliveries (periods) the orders feed is split into, by key parity.
PERIODS = (202501, 202502)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


AMOUNT = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING)"
CUSTOMER = "CAST(o_custkey AS STRING)"
DAY = "CAST(o_orderdate AS DATE)"
DIRTY = [
    "CAST(o_orderkey AS STRING) AS order_id",
    f"""CASE WHEN o_orderkey % 11 = 0 THEN 'abc'
             WHEN o_orderkey % 13 = 0 THEN concat('-', {AMOUNT})
             WHEN o_orderkey % 17 = 0 THEN NULL
             ELSE {AMOUNT} END AS amount""",
    f"""CASE WHEN o_orderkey % 7 = 0 THEN date_format({DAY}, 'dd-MM-yyyy')
             WHEN o_orderkey % 19 = 0 THEN concat(date_format({DAY}, 'yyyy'), '-02-30')
             ELSE date_format({DAY}, 'yyyy-MM-dd') END AS order_dt""",
    f"CASE WHEN o_orderkey % 23 = 0 THEN {CUSTOMER} ELSE lpad({CUSTOMER}, 16, '0') END AS cust_code",
    f"CASE WHEN o_orderkey % 29 = 0 THEN 'c@example' ELSE concat('c', {CUSTOMER}, '@example.com') END AS email",
    "CASE WHEN o_orderkey % 5 = 0 THEN o_orderpriority ELSE substring(o_orderpriority, 3) END AS priority",
]
DELIVERY = f"CASE WHEN o_orderkey % 2 = 0 THEN {PERIODS[0]} ELSE {PERIODS[1]} END AS delivery"


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(*DIRTY)


def dirty_orders_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed plus the delivery each order belongs to, in ``delivery``."""
    return table(spark, sf_dir, "orders").selectExpr(*DIRTY, DELIVERY)


def write_deliveries(spark: SparkSession, sf_dir: str, folder: str) -> str:
    """Both deliveries as CSV files ``<period>_orders-*.csv``; a pattern for them."""
    feed = dirty_orders_by_period(spark, sf_dir)
    for period in PERIODS:
        (
            feed.where(F.col("delivery") == period)
            .drop("delivery")
            .write.option("header", True)
            .option("mapreduce.output.basename", f"{period}_orders")
            .csv(f"{folder}/{period}")
        )
    return f"{folder}/*/*.csv"


def dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as text, with the e-mail column the orders feed has too."""
    return table(spark, sf_dir, "customer").selectExpr(
        "CAST(c_custkey AS STRING) AS customer_id",
        "c_name AS name",
        "CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING) AS balance",
        "concat('c', CAST(c_custkey AS STRING), '@example.com') AS email",
    )

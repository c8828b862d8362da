"""Append to a database table, in parallel from the executors."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from sieveline.operators.clean import PERIOD


def append_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    *,
    batchsize: int = 10_000,
    connections: int = 16,
    options: Mapping[str, str] | None = None,
) -> None:
    """Insert ``df`` into an existing table with batched statements.

    Each task is one connection and one transaction; at most ``connections`` tasks
    run the whole plan of ``df``, so pass a frame that is cheap to read, such as
    published Parquet, not one that still has to be cleaned. Driver class and
    credentials come from the caller in ``options``; there are no defaults.
    """
    (
        df.write.format("jdbc")
        .options(**(options or {}))
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batchsize)
        .option("numPartitions", connections)
        .mode("append")
        .save()
    )


def count_period(
    spark: SparkSession,
    url: str,
    table: str,
    period: int,
    *,
    period_name: str = PERIOD,
    options: Mapping[str, str] | None = None,
) -> int:
    """Rows of one period in the database table; the database counts."""
    query = f"SELECT COUNT(*) AS N FROM {table} WHERE {period_name} = {int(period)}"
    reader = spark.read.format("jdbc").options(**(options or {}))
    return int(reader.option("url", url).option("query", query).load().first()[0])


def check_empty(spark: SparkSession, url: str, table: str, period: int, **where) -> None:
    """Fail if the database table has rows of the period."""
    if present := count_period(spark, url, table, period, **where):
        raise ValueError(f"period {period} already has {present} rows in {table}; empty it first")


def load_period(
    df: DataFrame,
    url: str,
    table: str,
    period: int,
    *,
    period_name: str = PERIOD,
    options: Mapping[str, str] | None = None,
    empty_period: Callable[[int], None] | None = None,
    **append: int,
) -> int:
    """Append the rows of one period and check that the table then holds exactly
    those. Returns their number.

    ``empty_period`` is called with the period first; emptying is a statement of the
    database's own dialect and left to its owner. Then, or without it, the period must
    be empty. The check matters because a task whose executor is lost between its
    commit and its report runs again and inserts its rows twice; that is reported here,
    and the load can be repeated once the period is emptied.
    """
    spark, where = df.sparkSession, dict(period_name=period_name, options=options)
    if empty_period is not None:
        empty_period(period)
    check_empty(spark, url, table, period, **where)
    expected = df.count()
    append_jdbc(df, url, table, options=options, **append)
    loaded = count_period(spark, url, table, period, **where)
    if loaded != expected:
        raise RuntimeError(
            f"period {period} of {table} has {loaded} rows instead of {expected}; empty it and load again"
        )
    return loaded

"""Tables stored by period, of which a run replaces whole periods."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

from sieveline.functions.predicates import quoted
from sieveline.operators.clean import GOOD, PERIOD, REJECTS
from sieveline.sinks.layout import MARK, nullable, planned_layout, store_layout, stored_layout

KIND = "kind"


def guarded(df: DataFrame, period: Column, periods: Sequence[int]) -> DataFrame:
    """``df``; a row of any other period, or of none, fails the job that reads it."""
    message = F.concat(
        F.lit("row of a period that is not to be replaced: "), F.coalesce(period.cast("string"), F.lit("NULL"))
    )
    return df.where(F.when(period.isin(list(periods)), True).otherwise(F.raise_error(message).cast("boolean")))


def write_partitions(df: DataFrame, path: str, *columns: str, shuffled: bool = False) -> str:
    """Replace the partitions that ``df`` has rows of, in one job and commit. Returns
    what the names of its files begin with.

    Executors write in parallel to a staging folder and move their own files there
    (committer version 2); the driver's commit renames one folder per partition. Rows that
    were ``shuffled`` may lie in other tasks when one runs again, so there the driver
    moves the files of the attempts that count (version 1).
    """
    begins = f"part-{uuid.uuid4().hex}"
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("mapreduce.fileoutputcommitter.algorithm.version", "1" if shuffled else "2")
        .option("mapreduce.output.basename", begins)
        .partitionBy(*columns)
        .parquet(path)
    )
    return begins


def rows_by_partition(spark: SparkSession, path: str, folders: Sequence[str], begins: str, **columns) -> dict[tuple, int]:
    """Rows of the files a write has made, by partition, after its commit: one job over
    the partitions in ``folders`` that reads file footers and no data."""
    base = path.rstrip("/")
    schema = StructType([StructField(name, kind) for name, kind in columns.items()])
    mine = spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{f}" for f in folders])
    counted = mine.where(F.col("_metadata.file_name").startswith(begins)).groupBy(*map(quoted, columns)).count().collect()
    return {tuple(r)[:-1]: r["count"] for r in counted}


def one_each(spark: SparkSession, name: str, values: Sequence) -> DataFrame:
    """A row for each value, dealt out to the tasks."""
    tasks = min(len(values), spark.sparkContext.defaultParallelism)
    return spark.range(0, len(values), 1, tasks).select(F.element_at(F.array(*map(F.lit, values)), (F.col("id") + 1).cast("int")).alias(name))


def replace_periods(
    df: DataFrame,
    path: str,
    periods: Sequence[int],
    period_name: str = PERIOD,
    rebalance: bool = False,
    additive: bool = False,
) -> dict[int, int]:
    """Replace the given periods of the Parquet table at ``path``; other periods
    are untouched. Returns the rows written for each period.

    The table has one layout, its first one: other columns or types are refused before
    anything is written. With ``additive`` new columns are added to it (older periods
    have NULL there) and missing ones are NULL; types still have to agree.

    A failed job leaves the old rows and layout, and running it again gives the same table.
    A given period without rows is emptied by the same commit: each gets a row that only
    marks it as written, which ``read_table`` leaves out. A row of any other period, or of
    none, fails the job before anything is replaced.

    ``rebalance`` adds a shuffle that writes few, evenly sized files per period
    (large periods are split), for input whose periods lie scattered over all
    tasks.
    """
    periods = sorted(set(periods))
    if not periods:
        raise ValueError("no periods to replace")
    spark, period = df.sparkSession, quoted(period_name)
    layout = planned_layout(spark, path, df.drop(period_name).schema, period_name, additive)
    # Tasks sort their rows by partition before writing, but not by a literal.
    constant = F.lit(periods[0]) if len(periods) == 1 else period
    rows = guarded(df, period, periods).withColumn(period_name, constant.cast("int")).withColumn(MARK, F.lit(None).cast("boolean"))
    values = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields if f.name not in (period_name, MARK)]
    marks = one_each(spark, period_name, periods).select(quoted(period_name), *values, F.lit(True).alias(MARK))
    rows = rows.unionByName(marks)
    if rebalance:
        rows = rows.hint("rebalance", period_name)
    begins = write_partitions(rows, path, period_name, shuffled=rebalance)
    store_layout(spark, path, layout)
    folders = [f"{period_name}={p}" for p in periods]
    found = rows_by_partition(spark, path, folders, begins, **{period_name: IntegerType()})
    return {p: found[p,] - 1 for p in periods}


def replace_both(
    both: DataFrame,
    path: str,
    periods: Sequence[int],
    period_name: str = PERIOD,
    rebalance: bool = False,
    additive: bool = False,
) -> dict[int, dict[str, int]]:
    """Replace good rows and rejects of the given periods of the table at ``path`` in one
    pass over the feed and one commit; returns the rows of each period and kind.

    ``both`` is that of ``clean``: the period and one of the structs ``good`` and
    ``rejects``. A kind and period is a partition. Each gets a row with neither, which
    readers leave out: so one without rows is replaced by the same commit, and a
    failure leaves both kinds as they were. Layout, guard and ``rebalance`` are those of
    ``replace_periods``.
    """
    periods = sorted(set(periods))
    if not periods:
        raise ValueError("no periods to replace")
    spark, period = both.sparkSession, quoted(period_name)
    layout = planned_layout(spark, path, both.select(GOOD, REJECTS).schema, period_name, additive)
    kind = F.when(F.col(GOOD).isNotNull(), GOOD).otherwise(REJECTS)
    rows = guarded(both, period, periods).select(period.cast("int").alias(period_name), kind.alias(KIND), GOOD, REJECTS)
    empty = one_each(spark, period_name, periods).withColumn(KIND, F.explode(F.array(F.lit(GOOD), F.lit(REJECTS))))
    kinds = dict(both.dtypes)
    marks = empty.select(period_name, KIND, *[F.lit(None).cast(kinds[c]).alias(c) for c in (GOOD, REJECTS)])
    rows = rows.unionAll(marks)
    if rebalance:
        rows = rows.hint("rebalance", KIND, period_name)
    begins = write_partitions(rows, path, KIND, period_name, shuffled=rebalance)
    store_layout(spark, path, layout)
    columns = {KIND: StringType(), period_name: IntegerType()}
    folders = [f"{KIND}={k}/{period_name}={p}" for k in (GOOD, REJECTS) for p in periods]
    found = rows_by_partition(spark, path, folders, begins, **columns)
    return {p: {k: found[k, p] - 1 for k in (GOOD, REJECTS)} for p in periods}


def read_table(spark: SparkSession, path: str, period_name: str = PERIOD, kind: str = GOOD) -> DataFrame:
    """The whole table in its layout, period first; columns a period lacks are NULL.
    Filters on the period prune partitions. ``kind`` tells which rows of a table that
    holds both are meant."""
    layout = stored_layout(spark, path, period_name)
    if layout is None:
        raise ValueError(f"no table at {path}")
    both = layout.names == [GOOD, REJECTS] and all(isinstance(f.dataType, StructType) for f in layout.fields)
    parts = [StructField(KIND, StringType()) if both else StructField(MARK, BooleanType())]
    schema = StructType([*nullable(layout).fields, *parts, StructField(period_name, IntegerType())])
    df = spark.read.schema(schema).parquet(path)
    if not both:
        return df.where(F.col(MARK).isNull()).select(quoted(period_name), *map(quoted, layout.names))
    rows = df.where((F.col(KIND) == kind) & F.col(kind).isNotNull())
    return rows.select(quoted(period_name), *[F.col(kind)[c].alias(c) for c in layout[kind].dataType.names])

"""Publishes from a source whose tasks die after handing out part of their rows.

Run by ``test_lost_tasks.py`` in a process of its own: the session must allow
tasks to fail, which the session of the other tests does not.
"""

import json
import sys

from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sieveline import clean, metrics, parse_rules, read_table, replace_periods, with_foreign_key


def dying(batches):
    task = TaskContext.get()
    for i, batch in enumerate(batches):
        yield batch
        if i == 3 and task.attemptNumber() < 2 and task.partitionId() % 2 == 0:
            raise RuntimeError("executor lost")


def feed(spark: SparkSession) -> DataFrame:
    value = F.when(F.col("id") % 4 == 0, "x").otherwise(F.col("id").cast("string")).alias("V")
    df = spark.range(0, 40_000, numPartitions=4).select(value)
    return df.mapInPandas(dying, df.schema)


def main(folder: str) -> None:
    spark = (
        SparkSession.builder.master("local[4,4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "500")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    rules, out = parse_rules({"V": {"type": "positive_number"}}), {}
    for rebalance in (False, True):
        seen, path = Observation(), f"{folder}/good-{rebalance}"
        good = clean(feed(spark), rules, 202501, observation=seen).good
        rows = replace_periods(good, path, [202501], rebalance=rebalance)
        stored = read_table(spark, path).agg(F.count("*"), F.countDistinct("V")).first()
        out[f"rebalance={rebalance}"] = [rows[202501], *stored]
        out[f"observed, rebalance={rebalance}"] = seen.get
    out["metrics"] = {r.metric: r.rows_ok for r in metrics(feed(spark), rules).collect()}

    parent = spark.range(1000).union(spark.range(20_000, 30_000))
    flagged = with_foreign_key(feed(spark), "V", parent, "id", "ok", broadcast_bytes=0, hot_rows=100)
    replace_periods(flagged.select(F.lit(202501).alias("ID_PER"), "V", "ok"), f"{folder}/flagged", [202501])
    stored = read_table(spark, f"{folder}/flagged").agg(F.count("*"), F.count_if("ok"), F.countDistinct("V")).first()
    out["foreign key"] = list(stored)
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main(sys.argv[1])

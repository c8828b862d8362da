"""Folders all executors share, for data a run writes and reads back.

The cluster names the folder in ``spark.checkpoint.dir`` (or the caller by
``SparkContext.setCheckpointDir``). There is no fallback to a folder of one machine.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

# The folder of the run that is on, if its tables are owned by one.
_RUN: ContextVar[str | None] = ContextVar("run", default=None)


def shared_root(spark: SparkSession) -> str | None:
    """The shared folder, or None if neither session nor context names one."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return named or spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path under the shared folder that nothing else uses. The caller owns it
    and may delete it with ``delete_folder`` once its readers are done."""
    root = shared_root(spark)
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return f"{root.rstrip('/')}/sieveline/{purpose}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder made by ``new_folder``; other paths are refused."""
    if f"{(shared_root(spark) or '').rstrip('/')}/sieveline/" not in path:
        raise ValueError(f"{path} is not a folder of this library under the shared folder")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def written(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` stored once as Parquet in the shared folder and read back, which cuts
    its lineage: lost executors do not make it be computed again. Within a run that
    ``owned`` began, the table lies in the run's folder and goes with it."""
    spark = df.sparkSession
    run = _RUN.get()
    folder = f"{run}/{purpose}-{uuid.uuid4().hex}" if run else new_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def owned(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A function of a frame whose intermediate tables are its own: when its result is
    stored, or it fails, they are deleted, and one folder is left. Within another such
    function it is part of that one's run. The function may not read its tables lazily
    anywhere but in its result."""

    @wraps(function)
    def run(df: DataFrame, *args, **named) -> DataFrame:
        if _RUN.get():
            return function(df, *args, **named)
        path = new_folder(df.sparkSession, f"{function.__name__}-run")
        token = _RUN.set(path)
        try:
            result = function(df, *args, **named)
            _RUN.reset(token)
            token = None
            return written(result, function.__name__)
        finally:
            if token:
                _RUN.reset(token)
            delete_folder(df.sparkSession, path)

    return run

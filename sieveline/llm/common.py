"""What the operators share: Python workers that find the package, frames cut to
the columns in use."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from sieveline.functions.predicates import quoted

# White space between words, and what is not.
SPACE = "\\x20\\x09-\\x0D"
WORD = f"[^{SPACE}]+"


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from the folder the driver has it in.
    On a cluster whose executors do not have that folder, pass the package with
    ``--py-files`` as usual."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])


def keyed_texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Id and text as ``doc_id`` and ``text``; every other column is left behind, so
    that no name can clash."""
    return docs.select(quoted(id_column).alias("doc_id"), quoted(text_column).cast("string").alias("text"))


def text_hash(raw: bytes) -> int:
    """The value of Spark's ``xxhash64`` of a text."""
    value = xxhash.xxh64_intdigest(raw, seed=42)
    return value - (1 << 64) if value >> 63 else value


def map_batches(
    df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: StructType | str
) -> DataFrame:
    """``mapInArrow`` with workers that can import the package, and that give back what
    the task has freed when it ends: they serve tasks of later stages too, and drop what
    other operators have left in them."""
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(function.__module__)
        try:
            yield from function(batches)
        finally:
            release()

    return df.mapInArrow(run, schema)


#: By module, the caches that tasks of one operator share in a worker.
_KEPT: dict[str, list[Callable]] = {}


def kept(cached: Callable) -> Callable:
    """A cached function whose results a worker holds between the tasks of its operator,
    until one of another operator begins."""
    _KEPT.setdefault(cached.__module__, []).append(cached)
    return cached


def forget_others(module: str) -> None:
    """Drop what tasks of other modules have left in this process."""
    for other, caches in _KEPT.items():
        if other != module:
            for cached in caches:
                cached.cache_clear()


def release() -> None:
    """Give memory that this process has freed back to the system, as far as its
    allocators can."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)

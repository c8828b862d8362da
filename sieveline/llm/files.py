"""Files that tasks write and read in a folder all executors share.

A task names a file after its partition and a number of its own, so a task that runs
again never writes into the file of another attempt. Which files count is in the
manifest, a frame that Spark commits: files of lost attempts are in none. The folder
may be a mounted path or any store ``pyarrow.fs`` knows.
"""

from __future__ import annotations

import re
import uuid

import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame


def store_of(path: str) -> tuple[pafs.FileSystem, str]:
    if re.match(r"(file:)?/", path):
        return pafs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    return pafs.FileSystem.from_uri(path)


def make_folder(folder: str) -> None:
    store, path = store_of(folder)
    store.create_dir(path, recursive=True)


def task_file(folder: str, n: int, suffix: str) -> str:
    task = TaskContext.get()
    part = task.partitionId() if task else 0
    return f"{folder}/part-{part:05d}-{n:04d}-{uuid.uuid4().hex[:12]}{suffix}"


def spread(manifest: DataFrame, column: str) -> DataFrame:
    """The manifest dealt out so that each task reads a few of its files."""
    files = manifest.select(column).distinct().count()
    return manifest.repartition(max(1, files), column)

"""The layout a stored table promises, kept beside its data.

A Parquet table of many periods has as many schemas as writes. The layout file is the
one that holds: what does not fit it is refused before anything is written, and readers
take it instead of the schema of whichever file comes first.

A layout has versions, and a file each. A write plans the layout the table will have and
stores it as the next version only after its data is committed: a failed write leaves
the layout as it was, or none if there was none. The file is written under another name
and renamed, so there is never half a layout. A run that dies between both commits leaves
the new rows under the old layout; running it again completes it.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql.types import StructField, StructType

VERSION = re.compile(r"_layout-(\d+)\.json")
# The name of the only layout file that tables had before.
UNVERSIONED = "_layout.json"
#: Column of the files that is set in rows which only mark a partition as written.
MARK = "_mark"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _versions(spark: SparkSession, path: str) -> dict[int, str]:
    """The layout files of a table by version."""
    store, folder = _file_system(spark, path)
    if not store.exists(folder):
        return {}
    names = [status.getPath().getName() for status in store.listStatus(folder) if status.isFile()]
    found = {int(m[1]): name for name in names if (m := VERSION.fullmatch(name))}
    return found or ({0: UNVERSIONED} if UNVERSIONED in names else {})


def stored_layout(spark: SparkSession, path: str, period_name: str) -> StructType | None:
    """Columns of the table besides the period; None if there is no table. A table
    without a layout file has the union of its files' columns."""
    versions = _versions(spark, path)
    if versions:
        store, file = _file_system(spark, f"{path.rstrip('/')}/{versions[max(versions)]}")
        stream = store.open(file)
        try:
            text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return StructType.fromJson(json.loads(text))
    store, folder = _file_system(spark, path)
    if not store.exists(folder):
        return None
    try:
        found = spark.read.option("mergeSchema", True).parquet(path).schema
    except AnalysisException:
        return None
    return StructType([f for f in found.fields if f.name not in (period_name, MARK)])


def store_layout(spark: SparkSession, path: str, layout: StructType) -> None:
    """Store the layout as the next version, unless the last one is the same. Earlier
    versions stay: they are what the table promised before."""
    versions = _versions(spark, path)
    if versions and stored_layout(spark, path, "") == layout:
        return
    base = path.rstrip("/")
    store, file = _file_system(spark, f"{base}/_layout-{max(versions, default=0) + 1:06d}.json")
    _, draft = _file_system(spark, f"{base}/_draft-{uuid.uuid4().hex}")
    stream = store.create(draft, False)
    try:
        stream.write(bytearray(layout.json(), "utf-8"))
    finally:
        stream.close()
    if store.exists(file) or not store.rename(draft, file):
        store.delete(draft, False)
        raise RuntimeError(f"{file} was stored by another run at the same time")


def shown(layout: StructType) -> str:
    return layout.simpleString()


def nullable(layout: StructType) -> StructType:
    """Any column may be missing in a period, so all are nullable."""
    fields = [StructField(f.name, nullable(f.dataType) if isinstance(f.dataType, StructType) else f.dataType) for f in layout.fields]
    return StructType(fields)


def merged(stored: StructType, new: StructType, additive: bool, where: str = "") -> StructType:
    """The layout that holds after ``new`` is written: the stored one, or with
    ``additive`` the columns of both. ValueError, naming both, if ``new`` does not fit."""
    before, after = {f.name: f.dataType for f in stored.fields}, {f.name: f.dataType for f in new.fields}
    fields = []
    for name, kind in before.items():
        other = after.get(name, kind)
        if isinstance(kind, StructType) and isinstance(other, StructType):
            kind = other = merged(kind, other, additive, f"{where}{name}: ")
        if kind != other:
            raise ValueError(f"{where}column {name!r} is {other.simpleString()}; stored: {shown(stored)}, new: {shown(new)}")
        fields.append(StructField(name, kind))
    if not additive and set(before) != set(after):
        raise ValueError(f"{where}layout differs from the table's; stored: {shown(stored)}, new: {shown(new)}")
    fields += [StructField(name, kind) for name, kind in after.items() if name not in before]
    if len({f.name.lower() for f in fields}) < len(fields):
        raise ValueError(f"{where}column names differ in case only; stored: {shown(stored)}, new: {shown(new)}")
    return StructType(fields)


def planned_layout(spark: SparkSession, path: str, new: StructType, period_name: str, additive: bool) -> StructType:
    """The layout the table will have once ``new`` is written; nothing is stored."""
    if MARK in new.names:
        raise ValueError(f"a column is called {MARK!r}, like the one that marks written partitions")
    new, stored = nullable(new), stored_layout(spark, path, period_name)
    return new if stored is None else merged(nullable(stored), new, additive)

"""All-text CSV scan and the period carried by file names."""

from __future__ import annotations

import os
import re
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Six digits before the first underscore, and the same with a real month.
PERIOD = r"^[0-9]{6}_"
PERIOD_WITH_MONTH = r"^[0-9]{4}(0[1-9]|1[0-2])_"


def read_feed(
    spark: SparkSession,
    paths: str | Sequence[str],
    columns: Sequence[str] | None = None,
    check_header: bool = True,
) -> DataFrame:
    """Scan CSV files with a header row; every column is text.

    One scan may cover any number of files. Spark maps them by position, so each
    file's header is checked against the first one (or against ``columns``,
    which also saves the job that reads the first header) and the scan fails on a
    different layout; read such layouts apart and combine them by name. A file
    with empty or repeated headers gets made-up names (``_c3``, ``A0``, ``A1``)
    that never equal its header: pass ``check_header=False`` for it.
    """
    reader = spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", not check_header)
    if columns is not None:
        reader = reader.schema(StructType([StructField(c, StringType()) for c in columns]))
    return reader.csv(paths if isinstance(paths, str) else list(paths))


def _pattern(check_month: bool) -> str:
    return PERIOD_WITH_MONTH if check_month else PERIOD


def period_of(path: str, check_month: bool = False) -> int:
    """Period (``YYYYMM``) in front of the first underscore of a file name."""
    name = os.path.basename(path)
    if not re.match(_pattern(check_month), name):
        raise ValueError(f"file name {name!r} does not start with a period YYYYMM and an underscore")
    return int(name[:6])


def check_file_names(scan: DataFrame, check_month: bool = False) -> None:
    """Fail if any file of the scan has a name without a period. Reads no file: Spark
    has listed them when the scan was made."""
    wrong = []
    for path in scan.inputFiles():
        name = unquote(os.path.basename(path))
        if not re.match(_pattern(check_month), name):
            wrong.append(name)
    if wrong:
        shown = ", ".join(map(repr, sorted(wrong)[:20]))
        raise ValueError(f"{len(wrong)} file name(s) do not start with a period YYYYMM and an underscore: {shown}")


def file_period(check_month: bool = False) -> Column:
    """Period of the file each row comes from; a wrong name fails the jobs that
    use it. It belongs in the first projection on a file scan."""
    name = F.col("_metadata.file_name")
    message = F.concat(F.lit("file name without a leading period YYYYMM and an underscore: "), name)
    return F.when(name.rlike(_pattern(check_month)), F.substring(name, 1, 6).try_cast("int")).otherwise(
        F.raise_error(message).cast("int")
    )

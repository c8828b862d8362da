import os
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql.types import StringType, StructField, StructType

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

os.environ.setdefault("TZ", "UTC")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("sieveline-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def texts(spark):
    """A frame of text columns from rows, all columns strings."""

    def build(columns, rows):
        return spark.createDataFrame(rows, StructType([StructField(c, StringType()) for c in columns]))

    return build

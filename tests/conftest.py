from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql.types import DoubleType, StringType, StructField, StructType  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[4]")
               .appName("strata-tests")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.adaptive.enabled", "true")
               .config("spark.ui.enabled", "false")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SURVEY_SCHEMA = StructType([
    StructField("_STATE", DoubleType()),
    StructField("GENHLTH", DoubleType()),
    StructField("_BMI5", DoubleType()),
    StructField("_TOTINDA", DoubleType()),
    StructField("_AGEG5YR", DoubleType()),
    StructField("_RACE", DoubleType()),
    StructField("EXTRA", StringType()),
])

NAN = float("nan")

# Edge rows 1-9 of FIXTURES.md section 5 (row 10 = NaN measure, 11 = overflow).
EDGE_ROWS = [
    (1.0, 1.0, 2512.0, 1.0, 3.0, 1.0, "a"),
    (1.0, 5.0, 3000.0, 2.0, 4.0, 1.0, "b"),
    (2.0, 7.0, 2000.0, 9.0, 5.0, 2.0, "c"),
    (2.0, None, 2000.0, None, 6.0, 2.0, "d"),
    (2.0, 0.0, 2100.0, 9.0, 7.0, 1.0, "e"),
    (None, 2.5, 2200.0, None, 8.0, 1.0, "f"),
    (66.0, 3.0, None, 1.0, 9.0, 1.0, "g"),
    (66.0, 3.0, 0.0, 1.0, 10.0, 1.0, "h"),
    (99.0, 3.0, 2512.345, 1.0, 11.0, 1.0, "i"),
]
NAN_ROW = (1.0, 3.0, NAN, 1.0, 3.0, 1.0, "j")
OVERFLOW_ROW = (1.0, 3.0, 1e9, 1.0, 3.0, 1.0, "k")

REFERENCE_ROWS = [(1, "Alabama"), (2, "Alaska"), (66, "Guam")]


@pytest.fixture()
def edge_frame(spark):
    return spark.createDataFrame(EDGE_ROWS, SURVEY_SCHEMA)


@pytest.fixture()
def reference(spark):
    return spark.createDataFrame(REFERENCE_ROWS, "state_code int, state_name string")

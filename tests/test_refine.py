"""Unit cases for P2-P9 / C2 on the edge rows."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from strata.functions.labels import code_to_label
from strata.functions.decimals import scale_decimal
from strata.operators.refine import refine
from strata.spec import GENERAL_HEALTH_LABELS, SURVEY, ValidRule
from tests.conftest import NAN_ROW, OVERFLOW_ROW, SURVEY_SCHEMA


def _by_extra(df):
    return {r["EXTRA"]: r for r in df.collect()}


def test_silver_rows_and_columns(edge_frame):
    silver = refine(edge_frame.withColumn("EXTRA_KEEP", F.col("EXTRA")), SURVEY)
    assert silver.columns == ["State_Code", "General_Health", "BMI_Value",
                              "Physical_Activity_Status", "Age_Group_Code", "Race_Code"]
    types = dict(silver.dtypes)
    assert types["BMI_Value"] == "decimal(14,6)"
    assert types["State_Code"] == "double" and types["Race_Code"] == "double"
    got = sorted(((r.State_Code, r.General_Health, r.BMI_Value, r.Physical_Activity_Status)
                  for r in silver.collect()), key=lambda t: (t[2]))
    assert got == [
        (2.0, None, Decimal("21.000000"), "Unknown"),     # row 5: code 0 kept, NULL label
        (None, None, Decimal("22.000000"), "Unknown"),    # row 6: code 2.5 kept
        (1.0, "Excellent", Decimal("25.120000"), "Active"),
        (99.0, "Good", Decimal("25.123500"), "Active"),   # rounded half up before / 100
        (1.0, "Poor", Decimal("30.000000"), "Inactive"),
    ]


def test_min_code_gives_documented_rule(spark, edge_frame):
    from dataclasses import replace
    spec = replace(SURVEY, valid=ValidRule(measure="_BMI5", code="GENHLTH", max_code=5, min_code=1))
    # row 5 (code 0) now drops; row 6 (code 2.5, NULL state) stays
    codes = sorted((r.State_Code is None, r.State_Code) for r in refine(edge_frame, spec).collect())
    assert [c for _, c in codes] == [1.0, 1.0, 99.0, None]


def test_nan_measure_kept_raw(spark):
    df = spark.createDataFrame([NAN_ROW], SURVEY_SCHEMA)
    rows = refine(df, SURVEY).collect()
    assert len(rows) == 1 and rows[0].BMI_Value is None


def test_overflow_raises_under_ansi_and_nulls_when_safe(spark):
    df = spark.createDataFrame([OVERFLOW_ROW], SURVEY_SCHEMA)
    with pytest.raises(Exception) as info:
        refine(df, SURVEY).collect()
    assert "NUMERIC_VALUE_OUT_OF_RANGE" in str(info.value) or isinstance(info.value, ArithmeticException)
    rows = refine(df, SURVEY, safe_cast=True).collect()
    assert rows[0].BMI_Value is None


def test_labels_null_default_and_types(spark):
    df = spark.createDataFrame([(1,), (5,), (6,), (None,), (0,)], "c int")
    got = [r.l for r in df.select(code_to_label("c", GENERAL_HEALTH_LABELS).alias("l")).collect()]
    assert got == ["Excellent", "Poor", None, None, None]
    got = [r.l for r in df.select(code_to_label("c", {1: "A"}, "U").alias("l")).collect()]
    assert got == ["A", "U", "U", "U", "U"]
    # a double code 1.0 and a string '1' compare numerically
    df2 = spark.createDataFrame([(1.0, "1")], "d double, s string")
    row = df2.select(code_to_label("d", {1: "A"}).alias("a"), code_to_label("s", {1: "A"}).alias("b")).first()
    assert row.a == "A" and row.b == "A"


def test_scale_decimal_types(spark):
    df = spark.createDataFrame([(2512.345,), (-100.0,)], "x double")
    out = df.select(scale_decimal("x").alias("v"))
    assert out.dtypes == [("v", "decimal(14,6)")]
    assert [r.v for r in out.collect()] == [Decimal("25.123500"), Decimal("-1.000000")]


def test_filter_pushes_into_parquet_scan(spark, tmp_path, edge_frame):
    path = str(tmp_path / "bronze")
    edge_frame.write.parquet(path)
    plan = refine(spark.read.parquet(path), SURVEY)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "IsNotNull(_BMI5)" in plan and "GreaterThan(_BMI5,0.0)" in plan
    assert "EXTRA" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_typed_csv_read_equals_inferred(spark, tmp_path, edge_frame):
    from strata.sources.files import read_csv
    path = str(tmp_path / "src")
    edge_frame.write.option("header", True).csv(path)
    types = {c: "double" for c in ["_STATE", "GENHLTH", "_BMI5", "_TOTINDA", "_AGEG5YR", "_RACE"]}
    typed = read_csv(spark, path, infer=False, types=types)
    inferred = read_csv(spark, path, infer=True)
    assert typed.columns == inferred.columns
    a, b = refine(typed, SURVEY), refine(inferred, SURVEY)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_header_validation(spark, tmp_path):
    from strata.sources.files import read_csv
    good = tmp_path / "good.csv"
    good.write_text(" a ,b\n1,2\n")
    assert read_csv(spark, str(good), validate_header=True).columns == ["a", "b"]
    for bad in ("a,,b\n1,2,3\n", "a,A\n1,2\n"):
        p = tmp_path / "bad.csv"
        p.write_text(bad)
        with pytest.raises(ValueError):
            read_csv(spark, str(p), validate_header=True)

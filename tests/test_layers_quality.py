"""K1, K3, A4/A5, G1, G2, Q1-Q6."""

from __future__ import annotations

import datetime as dt

import pytest

from strata.operators.layers import (ingest_summary, layer_path, read_layer, safe_run_id,
                                     write_layer)
from strata.operators.marts import build_gold
from strata.operators.quality import (freshness_report, gold_rules, quality_report, require_rows,
                                      schema_report)
from strata.operators.refine import refine
from strata.spec import SURVEY, SURVEY_MART


def test_safe_run_id_and_layer_path():
    rid = "scheduled__2026-01-01T00:00:00+00:00/x"
    assert safe_run_id(rid) == "scheduled__2026-01-01T00-00-0000-00__x"
    assert layer_path("/base/", "silver", rid) == \
        "/base/scheduled__2026-01-01T00-00-0000-00__x/silver/filtered_data.parquet"
    assert layer_path("/b", "gold") == "/b/gold/aggregated_by_state.parquet"


def test_write_layer_counts_in_the_write_and_overwrites(spark, tmp_path):
    path = str(tmp_path / "layer")
    first = write_layer(spark.range(37), path)
    second = write_layer(spark.range(37), path)
    assert first.rows == second.rows == 37
    assert read_layer(spark, path).count() == 37


def test_missing_layer_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_layer(spark, str(tmp_path / "nope"))


def test_empty_guard(spark):
    with pytest.raises(RuntimeError):
        require_rows(spark.range(0), "topic")
    assert require_rows(spark.range(1), "topic").count() == 1


def test_ingest_summary():
    assert ingest_summary(25_001, "t") == {"records_sent": 25_001, "topic": "t", "chunks": 3}


def _report(df):
    return {r.rule: (r.violations, r.passed) for r in df.collect()}


def test_quality_rules_pass_and_fail(spark, edge_frame, reference):
    gold = build_gold(refine(edge_frame, SURVEY), reference, SURVEY_MART)
    rep = _report(quality_report(gold, gold_rules()))
    assert rep == {
        "ExpectColumnValuesToBeUnique": (0, True),
        "ExpectColumnValuesNotToBeNull": (0, True),
        "ExpectColumnValuesToBeBetween": (0, True),
        "ExpectColumnValuesToBeGreaterThan": (0, True),
    }
    # duplicate reference key -> duplicate State_Code
    ref = spark.createDataFrame([(1, "A"), (1, "B")], "state_code int, state_name string")
    dup = build_gold(refine(edge_frame, SURVEY), ref, SURVEY_MART)
    assert _report(quality_report(dup, gold_rules()))["ExpectColumnValuesToBeUnique"] == (1, False)


def test_all_nan_state_breaks_two_rules(spark, reference):
    # raw message decode: a state whose measures are all NaN -> count 0, mean NULL
    rows = [(5.0, 3.0, float("nan"), 1.0, 1.0, 1.0, "x")]
    from tests.conftest import SURVEY_SCHEMA
    df = spark.createDataFrame(rows, SURVEY_SCHEMA)
    gold = build_gold(refine(df, SURVEY), reference, SURVEY_MART)
    row = gold.first()
    assert row.record_count == 0 and row.bmi_mean is None
    rep = _report(quality_report(gold, gold_rules()))
    assert rep["ExpectColumnValuesNotToBeNull"] == (1, False)
    assert rep["ExpectColumnValuesToBeGreaterThan"] == (1, False)
    assert rep["ExpectColumnValuesToBeBetween"] == (0, True)


def test_schema_report(spark, edge_frame, reference, tmp_path):
    gold = build_gold(refine(edge_frame, SURVEY), reference, SURVEY_MART)
    path = str(tmp_path / "gold")
    write_layer(gold, path)
    rep = {r.column_name: r for r in schema_report(read_layer(spark, path)).collect()}
    assert all(r.passed for r in rep.values())
    assert rep["record_count"].actual_type == "bigint" and rep["record_count"].null_count == 0
    bad = gold.selectExpr("cast(State_Code as int) State_Code", "State_Name",
                          "cast(null as bigint) record_count")
    rep = {r.column_name: r for r in schema_report(bad).collect()}
    assert not rep["State_Code"].passed
    assert not rep["record_count"].passed          # NULL in a non-nullable column
    assert not rep["bmi_mean"].passed and rep["bmi_mean"].actual_type is None


def test_freshness(spark):
    d = dt.datetime
    manifest = spark.createDataFrame([
        (d(2024, 1, 1), d(2024, 1, 6)),       # exactly 5 days: ok
        (d(2024, 1, 1), d(2024, 1, 6, 23)),   # 5 days 23 h: late (elapsed, not calendar)
        (d(2024, 1, 1), d(2024, 1, 7)),       # 6 days: late
        (d(2024, 1, 1), None),                # never written: late
    ], "dropped timestamp_ntz, written timestamp_ntz")
    row = freshness_report(manifest, "dropped", "written").first()
    assert (row.runs, row.violations, row.max_delay_days, row.passed) == (4, 3, 6.0, False)

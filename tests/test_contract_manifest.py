"""Declared contract -> rules; run manifest -> freshness."""

from __future__ import annotations

import datetime as dt
import json

import pytest

from strata.operators.contract import load_contract, parse_contract
from strata.operators.layers import read_layer
from strata.operators.marts import build_gold
from strata.operators.quality import quality_report, run_freshness, schema_report
from strata.operators.refine import refine
from strata.plans.jobs import run_pipeline
from strata.spec import SURVEY, SURVEY_MART
from tests.conftest import REFERENCE_ROWS

# The Gold contract as declared (schema, rules, delay).
CONTRACT = {
    "schema": [
        {"name": "State_Code", "type": "double", "nullable": True},
        {"name": "State_Name", "type": "string", "nullable": True},
        {"name": "record_count", "type": "long", "nullable": False},
        {"name": "bmi_mean", "type": "double", "nullable": True},
    ],
    "quality_rules": [
        {"rule": "ExpectColumnValuesToBeUnique", "target": "State_Code", "condition": "UNIQUE"},
        {"rule": "ExpectColumnValuesNotToBeNull", "target": "bmi_mean", "condition": "NOT NULL"},
        {"rule": "ExpectColumnValuesToBeBetween", "target": "bmi_mean", "condition": "15.0 AND 45.0"},
        {"rule": "ExpectColumnValuesToBeGreaterThan", "target": "record_count", "condition": "0"},
    ],
    "SLA": {"max_delay": "5 days after upstream source drop"},
}


def test_contract_rules_match_builtin(spark, edge_frame, reference, tmp_path):
    contract = parse_contract(CONTRACT)
    assert contract.max_delay_days == 5
    assert [r.name for r in contract.rules][0] == "ExpectColumnValuesToBeUnique"
    gold = build_gold(refine(edge_frame, SURVEY), reference, SURVEY_MART)
    rep = quality_report(gold, list(contract.rules)).collect()
    assert len(rep) == 4 and all(r.passed for r in rep)
    assert all(r.passed for r in schema_report(gold, contract.schema).collect())
    # the same contract from a file
    yml = tmp_path / "contract.yaml"
    yml.write_text(__import__("yaml").safe_dump(CONTRACT))
    js = tmp_path / "contract.json"
    js.write_text(json.dumps(CONTRACT))
    assert load_contract(str(yml)).schema == load_contract(str(js)).schema == contract.schema


def test_bad_contract_entries():
    with pytest.raises(ValueError):
        parse_contract({"quality_rules": [{"rule": "ExpectColumnValuesToBeBetween",
                                           "target": "x", "condition": "low to high"}]})
    with pytest.raises(ValueError):
        parse_contract({"quality_rules": [{"rule": "NoSuchRule", "target": "x"}]})


def test_manifest_freshness(spark, tmp_path, edge_frame):
    src, ref = str(tmp_path / "src"), str(tmp_path / "ref")
    edge_frame.coalesce(1).write.option("header", True).csv(src)
    spark.createDataFrame(REFERENCE_ROWS, "state_code int, state_name string") \
        .coalesce(1).write.option("header", True).csv(ref)
    manifest = str(tmp_path / "manifest")
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    run_pipeline(spark, src, str(tmp_path / "out"), ref, run_id="r1", manifest=manifest,
                 dropped_at=now - dt.timedelta(days=1))
    run_pipeline(spark, src, str(tmp_path / "out"), ref, run_id="r2", manifest=manifest,
                 dropped_at=now - dt.timedelta(days=9))
    rows = read_layer(spark, manifest)
    assert rows.count() == 6
    assert {r.layer: r.row_count for r in rows.filter("run_id = 'r1'").collect()} == \
        {"bronze": 9, "silver": 5, "gold": 4}
    rep = run_freshness(rows).first()
    assert (rep.runs, rep.violations, rep.passed) == (2, 1, False)
    assert 9.0 <= rep.max_delay_days < 9.1


def test_contract_parsing_edges():
    doc = {"schema": [{"name": "x", "type": "BIGINT", "nullable": "false"},
                      {"name": "y", "type": "decimal(14, 6)", "nullable": "yes"}],
           "SLA": {"max_delay": "36 hours"}}
    c = parse_contract(doc)
    assert c.schema == (("x", "bigint", False), ("y", "decimal(14, 6)", True))
    assert c.max_delay_days == 1.5
    for bad in ({"schema": [{"name": "x", "type": "long", "nullable": "maybe"}]},
                {"schema": [{"name": "x", "type": "varchar2"}]},
                {"SLA": {"max_delay": "soon"}}):
        with pytest.raises(ValueError):
            parse_contract(bad)


def test_schema_report_repeated_and_dotted_names(spark):
    from strata.operators.quality import schema_report
    df = spark.createDataFrame([(1, None)], "`a.b` int, c string")
    rows = schema_report(df, (("a.b", "int", False), ("c", "string", False),
                              ("c", "string", True))).collect()
    assert [(r.column_name, r.null_count, r.passed) for r in rows] == \
        [("a.b", 0, True), ("c", 1, False), ("c", 1, True)]


def test_hour_delay_is_exact_and_backtick_names(spark):
    import datetime as dt
    from strata.operators.quality import freshness_report, schema_report
    c = parse_contract({"SLA": {"max_delay": "7 hours"}})
    d = dt.datetime
    manifest = spark.createDataFrame([(d(2026, 1, 1), d(2026, 1, 1, 7))],
                                     "dropped timestamp_ntz, written timestamp_ntz")
    row = freshness_report(manifest, "dropped", "written", c.max_delay_days).first()
    assert row.violations == 0 and row.target == "written-dropped<=7h"
    df = spark.createDataFrame([(1,)], "`we``ird` int")
    assert schema_report(df, (("we`ird", "int", False),)).first().passed

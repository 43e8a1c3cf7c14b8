"""Incremental Bronze that follows its messages; safe CSV; separate steps."""

from __future__ import annotations

import glob
import json
import os

import pytest

from strata.__main__ import main
from strata.operators.layers import read_layer, write_layer
from strata.plans.jobs import run_bronze_messages, run_message_path
from strata.sources.files import read_csv
from strata.sources.messages import FileTopic, publish, replay_topic
from strata.streaming.ingest import ingest_evolving, ingest_incremental
from tests.conftest import REFERENCE_ROWS, SURVEY_SCHEMA
from tests.test_marts import GOLD_EDGE


def _bronze(spark, base, topic, **more):
    result, schema = ingest_evolving(spark, topic, f"{base}/bronze", f"{base}/ck", **more)
    return result.rows, schema, read_layer(spark, f"{base}/bronze") if schema else None


def test_files_with_old_times_are_read(spark, tmp_path):
    topic = FileTopic(str(tmp_path / "topic"))
    out, ckpt = str(tmp_path / "bronze"), str(tmp_path / "ck")
    schema = spark.range(1).schema
    publish(spark.range(20), topic)
    assert ingest_incremental(spark, topic, schema, out, ckpt).rows == 20
    before = set(glob.glob(topic.path + "/*.parquet"))
    publish(spark.range(20, 40), topic)
    for f in set(glob.glob(topic.path + "/*.parquet")) - before:
        os.utime(f, (1_500_000_000, 1_500_000_000))
    assert ingest_incremental(spark, topic, schema, out, ckpt).rows == 20
    assert spark.read.parquet(out).count() == 40


def test_ids_fields_and_types_follow_the_messages(spark, tmp_path):
    base, topic = str(tmp_path), FileTopic(str(tmp_path / "topic"))
    big = 2 ** 53 + 1
    publish(spark.range(big, big + 20).selectExpr("id", "1L AS n", "CAST(NULL AS STRING) AS blank"), topic)
    rows, schema, bronze = _bronze(spark, base, topic)
    assert rows == 20 and bronze.dtypes == [("blank", "string"), ("id", "bigint"), ("n", "bigint")]
    assert bronze.distinct().count() == 20
    # a new field is added, without a rebuild
    publish(spark.range(3).selectExpr("id", "2L AS n", "7L AS blank", "'x' AS added"), topic)
    rows, schema, bronze = _bronze(spark, base, topic)
    assert rows == 3 and dict(bronze.dtypes)["added"] == "string"
    assert bronze.where("added IS NULL").count() == 20 and dict(bronze.dtypes)["blank"] == "bigint"
    # a fraction, then a text: the type changes and nothing is lost
    publish(spark.range(2).selectExpr("id", "2.5D AS n"), topic)
    assert dict(_bronze(spark, base, topic)[2].dtypes)["n"] == "double"
    publish(spark.range(1).selectExpr("id", "'many' AS n"), topic)
    rows, schema, bronze = _bronze(spark, base, topic)
    assert rows == 1 and dict(bronze.dtypes)["n"] == "string" and bronze.count() == 26
    assert {r.n for r in bronze.select("n").distinct().collect()} == {"1", "2", "2.5", "many"}
    assert sorted(r.id for r in bronze.collect())[-1] == big + 19
    assert _bronze(spark, base, topic)[0] == 0 and _bronze(spark, base, topic)[2].count() == 26


def test_malformed_messages_go_to_the_quarantine(spark, tmp_path):
    topic = FileTopic(str(tmp_path / "topic"))
    spark.createDataFrame([('{"a": 1}',), ("{broken",)], "value string").write.parquet(topic.path)
    with pytest.raises(Exception):
        _bronze(spark, str(tmp_path / "x"), topic)
    rows, _, bronze = _bronze(spark, str(tmp_path / "y"), topic, quarantine_path=str(tmp_path / "bad"))
    assert rows == 2 and [tuple(r) for r in bronze.collect()] == [(1,)]
    assert [r.value for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["{broken"]


def test_text_in_a_number_field_reaches_bronze_and_not_silver(spark, tmp_path, edge_frame, reference):
    topic, out, ckpt = FileTopic(str(tmp_path / "t")), str(tmp_path / "o"), str(tmp_path / "ck")
    publish(edge_frame, topic)
    run_message_path(spark, topic, out, reference, incremental=True, checkpoint=ckpt)
    publish(edge_frame.limit(1).selectExpr("*").withColumn("GENHLTH", edge_frame["EXTRA"]), topic)
    layers = run_message_path(spark, topic, out, reference, incremental=True, checkpoint=ckpt)
    assert (layers["bronze"].rows, layers["silver"].rows) == (1, 0)
    assert read_layer(spark, layers["bronze"].path).where("GENHLTH = 'a'").count() == 1
    assert sorted(map(tuple, read_layer(spark, layers["gold"].path).collect()), key=str) == sorted(GOLD_EDGE, key=str)


def test_all_null_column_survives_a_replay(spark, tmp_path):
    topic = FileTopic(str(tmp_path / "topic"))
    publish(spark.range(4).selectExpr("id", "CAST(NULL AS DOUBLE) AS extra"), topic)
    rows = replay_topic(spark, topic)
    assert sorted(rows.columns) == ["extra", "id"] and rows.where("extra IS NULL").count() == 4


def test_new_names_reach_gold_without_new_rows(spark, tmp_path, edge_frame):
    topic, out, ckpt = FileTopic(str(tmp_path / "t")), str(tmp_path / "o"), str(tmp_path / "ck")
    publish(edge_frame, topic)
    for name in ("One", "Renamed"):
        ref = spark.createDataFrame([(1, name)], "state_code int, state_name string")
        layers = run_message_path(spark, topic, out, ref, schema=SURVEY_SCHEMA, incremental=True, checkpoint=ckpt)
        gold = {r.State_Code: r.State_Name for r in read_layer(spark, layers["gold"].path).collect()}
        assert gold[1.0] == name and len(gold) == 4


def test_batch_and_incremental_runs_do_not_mix(spark, tmp_path, edge_frame, reference):
    topic, out, ckpt = FileTopic(str(tmp_path / "t")), str(tmp_path / "o"), str(tmp_path / "ck")
    publish(edge_frame, topic)
    args = dict(schema=SURVEY_SCHEMA, incremental=True, checkpoint=ckpt)
    layers = run_message_path(spark, topic, out, reference, **args)
    with pytest.raises(ValueError, match="incremental"):
        run_message_path(spark, topic, out, reference, schema=SURVEY_SCHEMA)
    assert run_message_path(spark, topic, out, reference, **args)["gold"].rows == layers["gold"].rows
    run_message_path(spark, topic, str(tmp_path / "b"), reference, schema=SURVEY_SCHEMA)
    with pytest.raises(ValueError, match="batch"):
        run_message_path(spark, topic, str(tmp_path / "b"), reference, **{**args, "checkpoint": str(tmp_path / "c2")})


def test_headers_of_all_files_are_checked(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.csv").write_text("A,B\n1,2\n")
    (tmp_path / "d" / "b.csv").write_text("B,A\n30,3\n")
    for more in ({}, {"infer": False}, {"validate_header": True}):
        with pytest.raises(Exception, match="header"):
            read_csv(spark, str(tmp_path / "d"), **more).collect()
    (tmp_path / "d" / "b.csv").write_text("A,B\n3,30\n")
    assert sorted(map(tuple, read_csv(spark, str(tmp_path / "d")).collect())) == [(1, 2), (3, 30)]


def test_single_steps(spark, tmp_path, edge_frame, capsys):
    src, ref, out = str(tmp_path / "src"), str(tmp_path / "ref"), str(tmp_path / "out")
    edge_frame.coalesce(1).write.option("header", True).csv(src)
    spark.createDataFrame(REFERENCE_ROWS, "state_code int, state_name string").write.option("header", True).csv(ref)
    topic = FileTopic(str(tmp_path / "topic"))
    publish(edge_frame, topic)
    assert run_bronze_messages(spark, topic, str(tmp_path / "m")).rows == 9

    def step(*argv):
        main([*argv, "--output-dir", out])
        return json.loads(capsys.readouterr().out.strip().splitlines()[-1])[argv[0]]

    types = ",".join(f"{c}=double" for c in ("_STATE", "GENHLTH", "_BMI5", "_TOTINDA", "_AGEG5YR", "_RACE"))
    for source in (("--input", src, "--types", types), ("--topic-dir", topic.path)):
        bronze = step("bronze", *source)
        silver = step("silver", "--bronze", bronze["path"])
        gold = step("gold", "--silver", silver["path"], "--ref-state-codes", ref)
        assert (bronze["rows"], silver["rows"], gold["rows"]) == (9, 5, 4)


def test_top_n_is_one_plan(spark):
    from strata.operators.marts import head_rows
    before = spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")
    head = head_rows(spark.range(0, 20_000, 1, 16).selectExpr("id * 7919 % 20000 AS k"), 3000, ["k"])
    assert "TakeOrderedAndProject" in head._jdf.queryExecution().executedPlan().toString()
    assert [r.k for r in head.collect()] == list(range(3000))
    assert spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold") == before


def test_write_layer_leaves_streaming_folders_alone(spark, tmp_path):
    os.makedirs(tmp_path / "layer" / "_spark_metadata")
    with pytest.raises(ValueError):
        write_layer(spark.range(1), str(tmp_path / "layer"))

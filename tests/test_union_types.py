"""One-pass type union of messages, and Bronze whose types change without a rewrite."""

from __future__ import annotations

import glob
import json
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DecimalType, DoubleType, LongType, StringType, StructField, StructType

from strata.operators.files import list_names, load_schema, read_text, store_schema, write_text
from strata.operators.layers import read_layer, write_layer
from strata.operators.parts import append_part, has_part, holds, read_parts, stored_as
from strata.sources.messages import NULL_ONLY, FileTopic, decode_messages, infer_message_schema, publish
from strata.streaming.ingest import ingest_evolving


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def _value(draw, depth=0):
    kind = draw.randrange(15 if depth < 2 else 11)
    if kind < 11:
        return [1, 2.0, -2.5, None, "x,1.5,y", "NaN", True, 2 ** 70, float("nan"), {}, []][kind]
    if kind == 11:
        return {draw.choice(["p", "q r", "x`y", 'a"1.5,', "OBJECT<"]): _value(draw, depth + 1) for _ in range(draw.randrange(3))}
    return [_value(draw, depth + 1) for _ in range(draw.randrange(3))] if kind < 14 else {"d": {"e": _value(draw, depth + 1)}}


def test_types_equal_json_inference(spark, tmp_path):
    draw = random.Random(11)
    for k in range(25):
        values = [json.dumps({draw.choice("abcdé"): _value(draw) for _ in range(4)}, ensure_ascii=False, separators=(",", ":"))
                  for _ in range(draw.randrange(1, 6))] + ["", "  "]
        messages = frame(spark, values)
        messages.write.text(str(tmp_path / str(k)))
        want = spark.read.json(str(tmp_path / str(k)))
        assert infer_message_schema(messages).simpleString() == want.schema.simpleString(), values
        got = decode_messages(spark, messages, normalize=False)
        # a bare NaN in a field of text is quoted by the parser of messages
        a, b = (sorted(str(r).replace('"NaN"', "NaN") for r in x.collect()) for x in (got, want))
        assert a == b, values


def test_one_job_and_no_staging(spark):
    messages = frame(spark, ['{"a": 1}', '{"a": 2.5, "b": {"c": [1, "x"]}}'])
    spark.sparkContext.setJobGroup("union", "union")
    schema = infer_message_schema(messages)
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("union"))
    spark.sparkContext.setJobGroup("other", "other")
    assert schema.simpleString() == "struct<a:double,b:struct<c:array<string>>>" and jobs <= 2  # one action: map and merge


def test_null_fields_are_marked(spark):
    values = ['{"a": null, "b": {"c": null, "d": 1}, "e": []}', '{"f": 1}']
    kept = infer_message_schema(frame(spark, values))
    assert kept.simpleString() == "struct<a:string,b:struct<c:string,d:bigint>,e:array<string>,f:bigint>"
    assert {f.name for f in kept if f.metadata == NULL_ONLY} == {"a", "e"}
    assert infer_message_schema(frame(spark, values), keep_null=False)["b"].dataType.simpleString() == "struct<d:bigint>"


def test_malformed_and_odd_messages(spark):
    with pytest.raises(Exception, match="(?i)malformed"):
        infer_message_schema(frame(spark, ['{"a": 1}', "{broken"]))
    with pytest.raises(ValueError, match="objects"):
        infer_message_schema(frame(spark, ["[1]", "[2]"]))
    assert infer_message_schema(frame(spark, ['{"a": 1}', "{broken", "[1]", "7", None]), lenient=True).simpleString() == "struct<a:bigint>"
    assert infer_message_schema(frame(spark, ["", None])).fields == []
    assert infer_message_schema(frame(spark, ['{"a": 1, "a": "x"}'])).simpleString() == "struct<a:string>"
    assert spark.conf.get("spark.sql.variant.allowDuplicateKeys") == "false"


def data_files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/v*/*/*.parquet")}


def test_a_changed_type_writes_only_new_files(spark, tmp_path):
    topic, bronze, ck = FileTopic(str(tmp_path / "t")), str(tmp_path / "b"), str(tmp_path / "ck")

    def run(df):
        publish(df, topic)
        ingest_evolving(spark, topic, bronze, ck)
        return read_layer(spark, bronze)

    first = run(spark.range(10).selectExpr("id", "named_struct('n', id, 'l', array(id)) AS o", "id AS m"))
    before, early = data_files(bronze), first.where("id < 5")  # a reader that has listed the first files
    second = run(spark.range(10, 20).selectExpr(
        "id", "named_struct('n', id + 0.5D, 'l', array('x', 'y'), 'more', true) AS o", "named_struct('k', 1L) AS m"))
    after = data_files(bronze)
    assert before.items() <= after.items() and len(after) > len(before)
    assert early.count() == 5 and sorted(r.o.n for r in early.collect()) == [0, 1, 2, 3, 4]
    assert second.schema.simpleString() == "struct<id:bigint,m:string,o:struct<l:array<string>,more:boolean,n:double>>"
    rows = {r.id: r for r in second.collect()}
    assert len(rows) == 20 and rows[3].o.n == 3.0 and rows[3].o.l == ["3"] and rows[3].o.more is None and rows[3].m == "3"
    assert rows[12].o.n == 12.5 and rows[12].m == '{"k":1}'
    assert sorted(list_names(spark, f"{bronze}/_schemas")) == ["0", "1"]
    # a part that is being written is not read; nor is a replayed one added again
    second.limit(1).write.parquet(f"{bronze}/v1/strata_batch=99")
    assert read_layer(spark, bronze).count() == 20
    assert has_part(spark, bronze, 0) and append_part(spark, spark.range(3), bronze, 0) == 0
    assert read_layer(spark, bronze).count() == 20
    with pytest.raises(ValueError, match="incremental"):
        write_layer(spark.range(1), bronze)


def test_evolving_refuses_a_batch_layer(spark, tmp_path):
    topic, bronze = FileTopic(str(tmp_path / "t")), str(tmp_path / "b")
    publish(spark.range(3), topic)
    write_layer(spark.range(3), bronze)
    with pytest.raises(ValueError, match="another folder"):
        ingest_evolving(spark, topic, bronze, str(tmp_path / "ck"))


def test_messages_of_nulls_alone_keep_their_rows(spark, tmp_path):
    topic, bronze, ck = FileTopic(str(tmp_path / "t")), str(tmp_path / "b"), str(tmp_path / "ck")
    publish(spark.range(4).selectExpr("CAST(NULL AS STRING) AS a"), topic)
    ingest_evolving(spark, topic, bronze, ck)
    assert read_layer(spark, bronze).count() == 4
    publish(spark.range(4).selectExpr("id AS a"), topic)
    _, schema = ingest_evolving(spark, topic, bronze, ck)
    assert schema.simpleString() == "struct<a:bigint>"
    assert sorted((r.a for r in read_layer(spark, bronze).collect()), key=str) == [0, 1, 2, 3] + [None] * 4


def test_type_rules():
    old = StructType([StructField("a", LongType()), StructField("s", StructType([StructField("x", LongType())]))])
    new = StructType([*old.fields[:1], StructField("b", StringType()),
                      StructField("s", StructType([StructField("x", LongType()), StructField("y", LongType())]))])
    assert holds(new, old) and not holds(old, new)
    assert not holds(StructType([StructField("a", DoubleType())]), StructType([StructField("a", LongType())]))
    assert holds(ArrayType(LongType()), ArrayType(LongType())) and not holds(ArrayType(DoubleType()), ArrayType(LongType()))
    want = StructType([StructField("a", DecimalType(38, 0)), StructField("b", StringType())])
    assert stored_as(want, old).simpleString() == "struct<a:bigint,b:string>"


def test_small_files(spark, tmp_path):
    path = str(tmp_path / "deep" / "er" / "file")
    assert read_text(spark, path) is None and load_schema(spark, path) is None and list_names(spark, path) == []
    write_text(spark, path, "one é\n")
    write_text(spark, path, "two")
    assert read_text(spark, path) == "two" and list_names(spark, str(tmp_path / "deep" / "er")) == ["file"]
    store_schema(spark, spark.range(1).schema, path)
    assert load_schema(spark, path) == spark.range(1).schema


def test_parts_of_no_batches(spark, tmp_path):
    schema = StructType([StructField("a", LongType())])
    assert read_parts(spark, str(tmp_path / "none"), schema).collect() == []
    assert read_parts(spark, str(tmp_path / "none"), schema).where(F.col("a") > 1).schema == schema

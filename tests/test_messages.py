"""F1-F3, K2, S4-S6, the message path against the CSV path (D3), reruns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.functions.json import decode_frame, encode_row
from strata.operators.refine import refine
from strata.sources.files import read_json_lines
from strata.sources.messages import FileTopic, decode_messages, publish, read_topic, replay_topic
from strata.spec import SURVEY
from strata.streaming.ingest import ingest_incremental
from tests.conftest import EDGE_ROWS, SURVEY_SCHEMA

# One message per source row as the reference producer writes them: missing
# numbers as a bare NaN, integer-valued codes sometimes without a fraction.
RAW_MESSAGES = [
    '{"_STATE": 1.0, "GENHLTH": 3.0, "_BMI5": NaN, "_TOTINDA": 1.0, "_AGEG5YR": 3, "_RACE": 1.0}',
    '{"_STATE": 1, "GENHLTH": 1, "_BMI5": 2512, "_TOTINDA": 1, "_AGEG5YR": 3, "_RACE": 1}',
    '{"_STATE": 2.0, "GENHLTH": 2.0, "_BMI5": 2000.0, "_TOTINDA": NaN, "_AGEG5YR": 3.0, "_RACE": 1.0}',
]


def _topic_from_values(spark, path, values):
    spark.createDataFrame([(v,) for v in values], "value string").write.parquet(path)
    return FileTopic(path)


def test_encode_decode_roundtrip_keeps_nan_and_nulls(spark):
    df = spark.createDataFrame([(1.0, float("nan"), None)], "a double, b double, c string")
    enc = df.select(encode_row(df).alias("value"))
    assert enc.first().value == '{"a":1.0,"b":NaN,"c":null}'
    back = decode_frame(enc, df.schema).first()
    assert back.a == 1.0 and back.b != back.b and back.c is None


def test_replay_matches_source(spark, tmp_path, edge_frame):
    topic = FileTopic(str(tmp_path / "topic"))
    summary = publish(edge_frame, topic)
    assert summary["records_sent"] == len(EDGE_ROWS)
    got = replay_topic(spark, topic, SURVEY_SCHEMA)
    assert got.exceptAll(edge_frame).count() == 0 and edge_frame.exceptAll(got).count() == 0
    assert read_topic(spark, topic).columns == ["value"]


def test_publish_cap_takes_first_rows(spark, tmp_path):
    topic = FileTopic(str(tmp_path / "topic"))
    summary = publish(spark.range(100).selectExpr("id * 3 % 100 as k"), topic, 5, ["k"])
    assert summary == {"records_sent": 5, "topic": topic.path, "chunks": 1}
    got = sorted(r.k for r in replay_topic(spark, topic, None).collect())
    assert got == [0, 1, 2, 3, 4]


def test_empty_topic_raises(spark, tmp_path):
    topic = _topic_from_values(spark, str(tmp_path / "t"), [])
    with pytest.raises(RuntimeError):
        replay_topic(spark, topic, SURVEY_SCHEMA)


def test_malformed_message_fails_fast(spark, tmp_path):
    topic = _topic_from_values(spark, str(tmp_path / "t"), ['{"_STATE": 1.0', '{"_STATE": 2.0}'])
    with pytest.raises(Exception):
        replay_topic(spark, topic, SURVEY_SCHEMA).collect()


def test_inferred_decode_unions_types(spark, tmp_path):
    topic = _topic_from_values(spark, str(tmp_path / "t"), RAW_MESSAGES)
    rows = replay_topic(spark, topic, None, normalize=False)
    # columns sorted by name by inference; int and float values -> double
    assert rows.columns == sorted(rows.columns)
    types = dict(rows.dtypes)
    assert types["_STATE"] == "double" and types["_BMI5"] == "double" and types["_AGEG5YR"] == "double"


def test_nan_normalisation_on_silver(spark, tmp_path):
    """D3: the raw decode keeps a NaN measure as a Silver row with NULL value;
    the normalised decode drops it, as the CSV path does."""
    topic = _topic_from_values(spark, str(tmp_path / "t"), RAW_MESSAGES)
    raw = refine(replay_topic(spark, topic, SURVEY_SCHEMA, normalize=False), SURVEY)
    norm = refine(replay_topic(spark, topic, SURVEY_SCHEMA, normalize=True), SURVEY)
    assert raw.count() == 3 and norm.count() == 2
    assert raw.filter(F.col("BMI_Value").isNull()).count() == 1
    # NaN activity code -> 'Unknown' either way
    assert {r.Physical_Activity_Status for r in norm.collect()} == {"Active", "Unknown"}


def test_message_path_equals_csv_path_on_silver(spark, tmp_path, edge_frame):
    csv_dir = str(tmp_path / "csv")
    edge_frame.write.option("header", True).csv(csv_dir)
    from strata.sources.files import read_csv
    path_a = refine(read_csv(spark, csv_dir), SURVEY)
    topic = FileTopic(str(tmp_path / "topic"))
    publish(read_csv(spark, csv_dir), topic)
    path_b = refine(replay_topic(spark, topic, None), SURVEY)
    assert path_a.exceptAll(path_b).count() == 0 and path_b.exceptAll(path_a).count() == 0
    assert path_a.count() == 5


def test_jsonl_read_infers(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"a": 1, "b": "x"}\n{"a": 2.5, "b": 3}\n')
    df = read_json_lines(spark, str(p))
    assert df.dtypes == [("a", "double"), ("b", "string")]


def test_incremental_ingest_rerun_and_new_rows(spark, tmp_path, edge_frame):
    topic = FileTopic(str(tmp_path / "topic"))
    out, ckpt = str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    publish(edge_frame, topic)
    first = ingest_incremental(spark, topic, SURVEY_SCHEMA, out, ckpt)
    assert first.rows == len(EDGE_ROWS)
    again = ingest_incremental(spark, topic, SURVEY_SCHEMA, out, ckpt)
    assert again.rows == 0
    assert spark.read.parquet(out).count() == len(EDGE_ROWS)
    publish(edge_frame.limit(2), topic)
    third = ingest_incremental(spark, topic, SURVEY_SCHEMA, out, ckpt)
    assert third.rows == 2
    assert spark.read.parquet(out).count() == len(EDGE_ROWS) + 2


def test_decode_messages_with_staging_uses_shared_dir(spark, tmp_path):
    msgs = spark.createDataFrame([('{"a": 1}',), ('{"a": 2}',)], "value string")
    assert sorted(r.a for r in decode_messages(spark, msgs).collect()) == [1, 2]


def test_kafka_missing_connector_is_a_clear_error(spark):
    from strata.sources.messages import KafkaTopic, kafka_available
    if kafka_available(spark):
        pytest.skip("Kafka connector present")
    with pytest.raises(RuntimeError, match="Kafka connector"):
        read_topic(spark, KafkaTopic("localhost:1", "t"))


def test_head_in_file_order_and_publish_csv(spark, tmp_path):
    from strata.sources.files import head_in_file_order, read_csv
    from strata.sources.messages import publish_csv
    src = tmp_path / "src"
    src.mkdir()
    # three files; file order = name order, then line order
    for i, name in enumerate(["a.csv", "b.csv", "c.csv"]):
        lines = ["k,v"] + [f"{i * 100 + j},{j}" for j in range(50)]
        (src / name).write_text("\n".join(lines) + "\n")
    df = read_csv(spark, str(src))
    got = [r.k for r in head_in_file_order(df, 60).collect()]
    assert sorted(got) == list(range(50)) + list(range(100, 110))
    assert head_in_file_order(df, None).count() == 150
    topic = FileTopic(str(tmp_path / "topic"))
    summary = publish_csv(spark, str(src), topic, chunk_size=25, max_records=60)
    assert summary == {"records_sent": 60, "topic": topic.path, "chunks": 3}
    assert sorted(r.k for r in replay_topic(spark, topic, None).collect()) == sorted(got)


def test_quarantine_keeps_good_rows(spark, tmp_path):
    good = '{"_STATE": 1.0, "GENHLTH": 1.0, "_BMI5": 2512.0, "_TOTINDA": 1.0, "_AGEG5YR": 3.0, "_RACE": 1.0}'
    topic = _topic_from_values(spark, str(tmp_path / "t"), [good, '{"_STATE": 1.0', "not json"])
    qpath = str(tmp_path / "q")
    rows = replay_topic(spark, topic, SURVEY_SCHEMA, quarantine_path=qpath)
    assert rows.columns == SURVEY_SCHEMA.fieldNames()
    assert rows.count() == 1
    assert sorted(r.value for r in spark.read.parquet(qpath).collect()) == ['not json', '{"_STATE": 1.0']


def test_file_drop_ingest_takes_only_new_files(spark, tmp_path):
    from strata.streaming.ingest import ingest_files_incremental
    drop, out, ckpt = str(tmp_path / "drop"), str(tmp_path / "out"), str(tmp_path / "ck")
    spark.range(0, 10).write.parquet(drop + "/a")
    schema = spark.range(1).schema
    first = ingest_files_incremental(spark, drop + "/a", schema, out, ckpt, max_files=1)
    assert first.rows == 10
    spark.range(10, 15).coalesce(1).write.mode("append").parquet(drop + "/a")
    second = ingest_files_incremental(spark, drop + "/a", schema, out, ckpt, max_files=1)
    assert second.rows == 5
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == list(range(15))


def test_schemaless_replay_keeps_nan_measure_numeric(spark, tmp_path, edge_frame):
    from tests.conftest import NAN_ROW
    frame = edge_frame.unionByName(spark.createDataFrame([NAN_ROW], SURVEY_SCHEMA))
    topic = FileTopic(str(tmp_path / "topic"))
    publish(frame, topic)
    raw = replay_topic(spark, topic, None, normalize=False)
    assert dict(raw.dtypes)["_BMI5"] == "double"
    assert raw.filter(F.isnan("_BMI5")).count() == 1
    assert refine(replay_topic(spark, topic, None), SURVEY).count() == 5


def test_decode_accepts_iso_timestamp_variants(spark):
    vals = ['{"t":"2024-01-01T00:09:58.778549"}', '{"t":"2026-01-01T00:00:00"}',
            '{"t":"2026-01-01 00:00:00"}']
    msgs = spark.createDataFrame([(v,) for v in vals], "value string")
    got = [str(r.t) for r in decode_frame(msgs, "t timestamp_ntz").collect()]
    assert got == ["2024-01-01 00:09:58.778549", "2026-01-01 00:00:00", "2026-01-01 00:00:00"]


def test_multiline_message_is_decoded_without_schema(spark):
    msgs = spark.createDataFrame([('{\n  "a": 1,\n  "b": "x y"\n}',), ('{"a": 2, "b": "z"}',)],
                                 "value string")
    rows = sorted((r.a, r.b) for r in decode_messages(spark, msgs).collect())
    assert rows == [(1, "x y"), (2, "z")]


def test_byte_estimate_counts_rows_with_null_strings(spark):
    from strata.operators.marts import broadcast_size
    df = spark.createDataFrame([("x" * 1000, None), ("y" * 1000, "z")], "a string, b string")
    assert broadcast_size(df) == (2, 2 * 16 + 2000 + 1)


def test_nan_rows_keep_column_order_with_nested_columns(spark):
    df = spark.createDataFrame([(1e20, float("nan"), [1]), (1.0, 2.0, [2])],
                               "a double, b float, c array<int>")
    vals = [r.value for r in df.select(encode_row(df).alias("value")).collect()]
    assert vals == ['{"a":1.0E20,"b":NaN,"c":[1]}', '{"a":1.0,"b":2.0,"c":[2]}']


def test_observed_metric_reader():
    from pyspark.sql import Row
    from strata.streaming.ingest import _observed

    class Progress:
        observedMetrics = {"silver_rows": Row(n=5), "other": Row(k=None)}

    assert _observed(Progress, "silver_rows") == 5
    assert _observed(Progress, "other") == 0
    assert _observed(Progress, "missing") == 0 and _observed(Progress, None) == 0


def test_aware_datetimes_without_zone(spark):
    import datetime as dt
    from strata.operators.layers import literal_frame
    aware = dt.datetime(2026, 1, 1, 10, tzinfo=dt.timezone(dt.timedelta(hours=2)))
    schema = spark.createDataFrame([], "t timestamp_ntz").schema
    got = literal_frame(spark, [(aware,), (dt.datetime(2026, 1, 1, 8),)], schema).collect()
    assert [r.t for r in got] == [dt.datetime(2026, 1, 1, 8)] * 2


def test_literal_frame_zoned_timestamp_keeps_instant(spark):
    import datetime as dt
    from pyspark.sql.types import StructField, StructType, TimestampType
    from strata.operators.layers import literal_frame
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        aware = dt.datetime(2026, 1, 1, 12, tzinfo=dt.timezone.utc)
        df = literal_frame(spark, [(aware,)], StructType([StructField("t", TimestampType())]))
        assert df.selectExpr("unix_timestamp(t) AS s").first().s == int(aware.timestamp())
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)

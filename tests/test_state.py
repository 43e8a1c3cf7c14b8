"""Mergeable Gold state: batches, replays, corrections; equal to a rebuild."""

from __future__ import annotations

import decimal
import glob

import pytest
from pyspark.sql import functions as F

from strata.operators.layers import read_layer
from strata.operators.marts import aggregate_by
from strata.operators.state import correction, expire_state, merge_state, read_state, signed
from strata.plans.jobs import run_message_path
from strata.sources.messages import FileTopic, publish
from strata.spec import MartSpec
from strata.streaming.layers import merged_state_path
from tests.conftest import SURVEY_SCHEMA
from tests.test_marts import GOLD_EDGE

MART = MartSpec(key="k", measure="v", count_name="n", mean_name="mean")
SCHEMA = "k double, v decimal(14,6)"


def frame(spark, rows):
    return spark.createDataFrame([(k, None if v is None else decimal.Decimal(str(v))) for k, v in rows], SCHEMA)


def table(df):
    return sorted(str(tuple(r)) for r in df.collect())  # as text: NaN equals NaN


def same_as_rebuild(spark, path, rows):
    assert table(read_state(spark, path, MART)) == table(aggregate_by(frame(spark, rows), "k", "v", "n", "mean"))


NAN = float("nan")
FIRST = [(1.0, 2.5), (1.0, 3.1), (2.0, None), (None, 7.123457), (NAN, 1), (0.0, 1), (-0.0, 2), (5.0, 9)]


def test_batches_equal_a_rebuild(spark, tmp_path):
    path, second = str(tmp_path / "s"), [(1.0, 0.000001), (2.0, 4), (6.0, None), (NAN, 3), (None, 1), (-0.0, 5)]
    merge_state(frame(spark, FIRST), path, MART, 0)
    same_as_rebuild(spark, path, FIRST)
    assert merge_state(frame(spark, second), path, MART, 1)
    same_as_rebuild(spark, path, FIRST + second)
    assert merge_state(frame(spark, second), path, MART, 1) == [] == merge_state(frame(spark, FIRST), path, MART, 0)  # replayed
    same_as_rebuild(spark, path, FIRST + second)
    assert merge_state(frame(spark, []), path, MART, 2) == []
    same_as_rebuild(spark, path, FIRST + second)


def test_a_correction_touches_one_bucket(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = [(float(k % 40), k / 7) for k in range(400)]
    rows = [(k, round(v, 6)) for k, v in rows]
    merge_state(frame(spark, rows), path, MART, 0)
    before = {b: f for b in range(16) for f in glob.glob(f"{path}/data/*/state/bucket={b}/*.parquet")}
    reader = read_state(spark, path, MART)  # listed before the correction
    old = [r for r in rows if r[0] == 7.0][:3]
    new = [(7.0, 100.5), (7.0, None), (7.0, 3)]
    touched = merge_state(correction(frame(spark, old), frame(spark, new)), path, MART, 0, "late")
    assert len(touched) == 1
    after = glob.glob(f"{path}/data/*/state/bucket=*/*.parquet")
    assert len(after) == len(before) + 1
    left = rows.copy()
    for r in old:
        left.remove(r)
    same_as_rebuild(spark, path, left + new)
    assert reader.count() == 40  # its files are still there
    assert merge_state(correction(frame(spark, new), frame(spark, new)), path, MART, 1, "late") == []  # nothing changes
    gone = expire_state(spark, path)
    assert all("late-0" not in g for g in gone)
    same_as_rebuild(spark, path, left + new)


def test_keys_leave_and_cannot_be_overdrawn(spark, tmp_path):
    path = str(tmp_path / "s")
    merge_state(frame(spark, FIRST), path, MART, 0)
    merge_state(signed(frame(spark, [(5.0, 9), (None, 7.123457)]), -1), path, MART, 0, "late")
    same_as_rebuild(spark, path, [r for r in FIRST if r[0] is not None and r[0] != 5.0])
    with pytest.raises(Exception, match="taken back"):
        merge_state(signed(frame(spark, [(1.0, 1)] * 3), -1), path, MART, 1, "late")
    same_as_rebuild(spark, path, [r for r in FIRST if r[0] is not None and r[0] != 5.0])
    with pytest.raises(ValueError, match="holds"):
        merge_state(frame(spark, FIRST).withColumn("v", F.lit(1.5)), path, MART, 9)
    with pytest.raises(FileNotFoundError):
        read_state(spark, str(tmp_path / "none"), MART)


def test_all_keys_can_leave(spark, tmp_path):
    path = str(tmp_path / "s")
    merge_state(frame(spark, FIRST), path, MART, 0)
    merge_state(signed(frame(spark, FIRST), -1), path, MART, 0, "late")
    assert read_state(spark, path, MART).collect() == []


def test_double_measures(spark, tmp_path):
    path = str(tmp_path / "s")
    rows = spark.createDataFrame([("a", 1.5), ("a", 2.5), ("b", None)], "k string, v double")
    merge_state(rows, path, MART, 0, buckets=2)
    assert table(read_state(spark, path, MART)) == ["('a', 2, 2.0)", "('b', 0, None)"]


def test_incremental_runs_with_merged_state(spark, tmp_path, edge_frame, reference):
    topic, out, ckpt = FileTopic(str(tmp_path / "t")), str(tmp_path / "o"), str(tmp_path / "ck")
    args = dict(schema=SURVEY_SCHEMA, incremental=True, checkpoint=ckpt, merged=True)
    publish(edge_frame.limit(0), topic)
    assert run_message_path(spark, topic, out, reference, **args)["gold"].rows == 0
    publish(edge_frame, topic)
    layers = run_message_path(spark, topic, out, reference, **args)
    gold = lambda: sorted(map(tuple, read_layer(spark, layers["gold"].path).collect()), key=str)
    assert gold() == sorted(GOLD_EDGE, key=str)
    publish(edge_frame, topic)
    run_message_path(spark, topic, out, reference, **args)
    twice = sorted(((k, name, 2 * n, mean) for k, name, n, mean in GOLD_EDGE), key=str)
    assert gold() == twice
    silver = read_layer(spark, layers["silver"].path).limit(5)
    from strata.spec import SURVEY_MART
    merge_state(signed(read_layer(spark, layers["silver"].path), -1), merged_state_path(ckpt), SURVEY_MART, 0, "corrections")
    assert silver.count() == 5 and run_message_path(spark, topic, out, reference, **args)["gold"].rows == 0

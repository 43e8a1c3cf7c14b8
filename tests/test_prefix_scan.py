"""The head of files in order, reading little more than the head; types of text columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strata.functions.kinds import text_types
from strata.operators.layers import read_layer
from strata.plans.jobs import run_bronze
from strata.sources import files
from strata.sources.files import head_of_files, read_csv
from strata.sources.messages import FileTopic, publish_csv, replay_topic


def folder(tmp_path, counts, name="src"):
    """Files with so many rows; row k of file i is i * 1000 + k."""
    src = tmp_path / name
    src.mkdir()
    for i, n in enumerate(counts):
        (src / f"part {i:03d}.csv").write_text("k,v\n" + "".join(f"{i * 1000 + k},x{k}\n" for k in range(n)))
    return str(src)


def head(spark, path, n):
    return [int(r.k) for r in head_of_files(spark, path, n, lambda p: read_csv(spark, p, infer=False)).collect()]


@pytest.mark.parametrize("n", [0, 1, 9, 10, 11, 25, 30, 31, 500])
def test_head_in_order(spark, tmp_path, n):
    counts = [10, 0, 15, 5, 0, 1, 30, 2]
    every = [i * 1000 + k for i, c in enumerate(counts) for k in range(c)]
    assert sorted(head(spark, folder(tmp_path, counts), n)) == every[:n]


def tasks_of(spark, run):
    """(result, tasks that ran)"""
    spark.sparkContext.setJobGroup("prefix", "prefix")
    try:
        out = run()
    finally:
        spark.sparkContext.setJobGroup("other", "other")
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("prefix") for s in tracker.getJobInfo(j).stageIds}
    return out, sum(info.numCompletedTasks for s in stages if (info := tracker.getStageInfo(s)))


def test_later_files_are_not_read(spark, tmp_path):
    src = folder(tmp_path, [20] * 40)
    for i in range(6, 40):  # a read of these fails: another header
        (tmp_path / "src" / f"part {i:03d}.csv").write_text("v,k\nx,1\n")
    with pytest.raises(Exception, match="header"):
        read_csv(spark, src, infer=False).collect()
    got, tasks = tasks_of(spark, lambda: head(spark, src, 50))
    assert sorted(got) == [i * 1000 + k for i in range(3) for k in range(20)][:50]
    assert tasks <= 20  # headers, counts and rows of the first few files
    topic = FileTopic(str(tmp_path / "topic"))
    assert publish_csv(spark, src, topic, max_records=45)["records_sent"] == 45
    assert replay_topic(spark, topic).count() == 45


def test_one_large_file_is_read_from_the_front(spark, tmp_path):
    big = tmp_path / "big.csv"
    big.write_text("k,v\n" + "".join(f"{k},{'y' * 50}\n" for k in range(200_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(32 * 1024))
    try:
        assert read_csv(spark, str(big), infer=False).rdd.getNumPartitions() > 300
        got, tasks = tasks_of(spark, lambda: head(spark, str(big), 1500))
        assert got == list(range(1500)) and tasks <= 30
        assert sorted(head(spark, str(big), 150_000)) == list(range(150_000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_a_long_rest_does_not_pass_the_driver(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "TAKE_ROWS", 5)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    try:
        src = folder(tmp_path, [40, 40])
        assert sorted(head(spark, src, 60)) == [*range(40), *range(1000, 1020)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_windows_stay_within_their_bytes(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "WINDOW_BYTES", 1)
    assert sorted(head(spark, folder(tmp_path, [3, 3, 3, 3]), 8)) == [0, 1, 2, 1000, 1001, 1002, 2000, 2001]


def test_no_files(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        head(spark, str(tmp_path / "none"), 3)


EDGE = {
    "whole": ["1", "-2", None], "signed": ["+5", "6", "7"], "long": ["1", "3000000000", None],
    "big": ["1", "12345678901234567890123", None], "fraction": ["1", "2.50", ".5"], "exponent": ["1e3", "2", "3.5E-2"],
    "missing": ["1.5", "NaN", None], "flag": ["true", "FALSE", None], "word": ["1", "x", None], "mixed": ["true", "1", None],
    "day": ["2024-01-31", "1999-12-01", None], "time": ["2024-01-31 10:11:12", "2024-01-31", None],
    "iso": ["2024-01-31T10:11:12", "2024-01-31T10:11:12.5", None], "bad_day": ["2024-02-31", "2024-01-01", None],
    "empty": [None, None, None], "spaced": ["a b", " c", "d "], "code": ["0012", "7", "08"], "inf": ["Inf", "1.0", "-Inf"],
    "words": ["Infinity", "nan", "1"], "dash": ["-", "1", "2"],
}


def test_types_equal_inference(spark, tmp_path):
    path = str(tmp_path / "edge.csv")
    with open(path, "w") as out:
        out.write(",".join(EDGE) + "\n")
        for k in range(3):
            out.write(",".join(EDGE[c][k] or "" for c in EDGE) + "\n")
    want = {f.name: f.dataType.simpleString() for f in read_csv(spark, path, infer=True).schema}
    assert text_types(read_csv(spark, path, infer=False)) == want


def test_types_of_few_values(spark, tmp_path):
    df = read_csv(spark, folder(tmp_path, [5, 5]), infer=False)
    assert text_types(df) == {"k": "int", "v": "string"}
    assert text_types(spark.createDataFrame([("1f",), ("2d",)], "h string")) == {"h": "string"}
    assert text_types(df.where(F.lit(False))) == {"k": "string", "v": "string"}


def test_bronze_finds_its_types_as_it_writes(spark, tmp_path):
    path = str(tmp_path / "edge.csv")
    with open(path, "w") as out:
        out.write(",".join(EDGE) + "\n")
        for k in range(3):
            out.write(",".join(EDGE[c][k] or "" for c in EDGE) + "\n")
    want = read_csv(spark, path, infer=True)
    layer, _ = tasks_of(spark, lambda: run_bronze(spark, path, str(tmp_path / "o"), one_pass=True))
    got = read_layer(spark, layer.path)
    assert layer.rows == 3 and got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    (tmp_path / "edge.csv").write_text("whole\nx\n")  # a rerun overwrites text, types and schema
    run_bronze(spark, path, str(tmp_path / "o"), one_pass=True)
    assert [tuple(r) for r in read_layer(spark, layer.path).collect()] == [("x",)]
    with pytest.raises(ValueError, match="one_pass"):
        run_bronze(spark, path, str(tmp_path / "o"), one_pass=True, types={"whole": "int"})

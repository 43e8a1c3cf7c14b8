"""Freshness of each drop, from the files' own times and the runs' manifest."""

from __future__ import annotations

import datetime as dt
import os

from strata.operators.quality import delivery_report, source_files


def at(day, hour=0):
    return dt.datetime(2026, 3, day, hour, tzinfo=dt.timezone.utc).replace(tzinfo=None)


MANIFEST = "run_id string, layer string, written_at timestamp"


def test_files_and_writes(spark, tmp_path):
    for name, day in (("a.csv", 1), ("b.csv", 2), ("deep/c.csv", 9), ("d.csv", 20), ("e.csv", 27)):
        path = tmp_path / "drop" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x")
        moment = dt.datetime(2026, 3, day, tzinfo=dt.timezone.utc).timestamp()
        os.utime(path, (moment, moment))
    drops = source_files(spark, str(tmp_path / "drop"))
    assert drops.count() == 5
    writes = spark.createDataFrame([("r1", "gold", at(2)), ("r2", "gold", at(16)), ("r2b", "gold", at(16)), ("s", "silver", at(28)),
                                    ("none", "gold", None)], MANIFEST)
    got = {os.path.basename(r.file): (r.run_id, r.delay_seconds, r.status) for r in delivery_report(
        drops, writes, now=dt.datetime(2026, 3, 30, tzinfo=dt.timezone.utc)).collect()}
    assert got == {"a.csv": ("r1", 86400, "on_time"), "b.csv": ("r1", 0, "on_time"), "c.csv": ("r2", 7 * 86400, "late"),
                   "d.csv": (None, None, "missing"), "e.csv": (None, None, "pending")}


def test_no_drops_no_writes_and_missing_times(spark):
    none = spark.createDataFrame([], MANIFEST)
    drops = spark.createDataFrame([(1, at(3)), (2, None), (1, at(3))], "k int, dropped_at timestamp")
    got = sorted((r.k, r.status) for r in delivery_report(drops, none).collect())
    assert got == [(1, "missing"), (1, "missing"), (2, "missing")]
    assert delivery_report(drops.limit(0), none).collect() == []
    writes = spark.createDataFrame([("old", "gold", at(1)), ("r", "gold", at(3, 5))], MANIFEST)
    assert {(r.k, r.run_id) for r in delivery_report(drops, writes).collect()} == {(1, "r"), (2, None)}
    assert delivery_report(drops.where("k = 2"), writes).collect()[0].status == "missing"

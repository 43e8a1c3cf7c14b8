"""A1-A3, J1-J3, O1, S7 / C3 on the edge rows."""

from __future__ import annotations

import pytest

from strata.operators.marts import (aggregate_by, build_gold, fits_broadcast, head_rows,
                                    lookup_left_join, sized_broadcast)
from strata.operators.refine import refine
from strata.spec import SURVEY, SURVEY_MART

GOLD_EDGE = [
    (None, None, 1, 22.0),
    (1.0, "Alabama", 2, 27.56),
    (2.0, "Alaska", 1, 21.0),
    (99.0, None, 1, 25.1235),
]


def test_gold_from_edge_rows(edge_frame, reference):
    gold = build_gold(refine(edge_frame, SURVEY), reference, SURVEY_MART)
    assert gold.columns == ["State_Code", "State_Name", "record_count", "bmi_mean"]
    assert dict(gold.dtypes) == {"State_Code": "double", "State_Name": "string",
                                 "record_count": "bigint", "bmi_mean": "double"}
    # ordered by key, NULL first
    assert [tuple(r) for r in gold.collect()] == GOLD_EDGE


def test_duplicate_reference_key_fans_out(spark, edge_frame):
    ref = spark.createDataFrame([(1, "Alabama"), (1, "Alabama-2"), (2, "Alaska")],
                                "state_code int, state_name string")
    gold = build_gold(refine(edge_frame, SURVEY), ref, SURVEY_MART)
    assert gold.count() == 5


def test_lookup_mixed_type_and_case_only_names(spark):
    facts = spark.createDataFrame([(1.0, 10), (3.0, 5), (None, 2)], "State_Code double, n int")
    ref = spark.createDataFrame([(1, "A"), (2, "B")], "state_code int, state_name string")
    out = lookup_left_join(facts, ref, "State_Code", "state_code", "state_name", "State_Name")
    assert sorted(out.columns) == ["State_Code", "State_Name", "n"]
    got = {r.State_Code: r.State_Name for r in out.collect()}
    assert got == {1.0: "A", 3.0: None, None: None}


def test_nan_and_negative_zero_groups(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (float("nan"), 3.0), (0.0, 1.0), (-0.0, 2.0),
                                (None, 5.0)], "k double, v double")
    out = {(str(r.k)): (r.record_count, r.bmi_mean) for r in aggregate_by(df, "k", "v").collect()}
    assert out == {"nan": (2, 2.0), "0.0": (2, 1.5), "None": (1, 5.0)}


def test_count_is_of_non_null_measure(spark):
    df = spark.createDataFrame([(1.0, None), (1.0, 2.0)], "k double, v double")
    row = aggregate_by(df, "k", "v").first()
    assert row.record_count == 1 and row.bmi_mean == 2.0


def test_sized_broadcast_checks_rows(spark):
    from strata.operators.marts import broadcast_size
    small = spark.range(10)
    assert fits_broadcast(small, 10) and not fits_broadcast(small, 9)
    assert broadcast_size(small) == (10, 10 * 24)
    wide = spark.range(10).selectExpr("id", "repeat('x', 100000) AS s")
    rows, size = broadcast_size(wide)
    assert rows == 10 and size == 10 * 24 + 10 * 100_000
    assert not fits_broadcast(wide, 100, max_bytes=500_000)
    big = spark.range(100)
    joined = spark.range(5).join(sized_broadcast(big, 50), "id")
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" not in plan.lower()
    joined = spark.range(5).join(sized_broadcast(big, 500), "id")
    assert "broadcast" in joined._jdf.queryExecution().optimizedPlan().toString().lower()


def test_head_rows(spark):
    df = spark.range(100).selectExpr("id * 7 % 100 as k")
    assert [r.k for r in head_rows(df, 3, ["k"]).collect()] == [0, 1, 2]
    assert head_rows(df, 0, ["k"]).count() == 0
    assert head_rows(df, None).count() == 100
    with pytest.raises(ValueError):
        head_rows(df, -1)


def test_hot_key_join_without_broadcast_is_split(spark):
    """A third of the facts on one key, the lookup too big to broadcast:
    the join shuffles and AQE splits the hot partition; results stay whole."""
    from pyspark.sql import functions as F
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 30_000
        facts = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 997 + 1)
             .cast("double").alias("k"), F.col("id"))
        ref = spark.range(1000).select(F.col("id").cast("int").alias("code"),
                                       F.concat(F.lit("n"), F.col("id")).alias("name"))
        out = lookup_left_join(facts, ref, "k", "code", "name", "name", max_broadcast_rows=10)
        rows = out.groupBy((F.col("k") == 0).alias("hot")).agg(
            F.count("*").alias("n"), F.count("name").alias("named")).collect()
        got = {r.hot: (r.n, r.named) for r in rows}
        assert got == {True: (10_000, 10_000), False: (20_000, 20_000)}
        assert len(out.collect()) == n
        final = out._jdf.queryExecution().executedPlan().toString()
        assert "isFinalPlan=true" in final and "Broadcast" not in final
        assert "SortMergeJoin(skew=true)" in final
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)

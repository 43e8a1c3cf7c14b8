"""C1-C5 end to end on the edge rows, plus reruns."""

from __future__ import annotations

from strata.operators.layers import read_layer
from strata.plans.jobs import run_message_path, run_pipeline
from strata.sources.messages import FileTopic, publish
from tests.conftest import EDGE_ROWS, REFERENCE_ROWS
from tests.test_marts import GOLD_EDGE


def _write_inputs(spark, tmp_path, edge_frame):
    src, ref = str(tmp_path / "source.csv"), str(tmp_path / "ref.csv")
    edge_frame.coalesce(1).write.option("header", True).csv(src)
    spark.createDataFrame(REFERENCE_ROWS, "state_code int, state_name string") \
        .coalesce(1).write.option("header", True).csv(ref)
    return src, ref


def test_csv_pipeline(spark, tmp_path, edge_frame):
    src, ref = _write_inputs(spark, tmp_path, edge_frame)
    out = str(tmp_path / "out")
    layers = run_pipeline(spark, src, out, ref, run_id="manual__2026-01-01T00:00:00+00:00")
    assert layers["bronze"].rows == len(EDGE_ROWS)
    assert layers["silver"].rows == 5 and layers["gold"].rows == 4
    assert "manual__2026-01-01T00-00-0000-00/gold" in layers["gold"].path
    bronze = read_layer(spark, layers["bronze"].path)
    assert "EXTRA" in bronze.columns                      # Bronze keeps every column
    assert "EXTRA" not in read_layer(spark, layers["silver"].path).columns
    gold = read_layer(spark, layers["gold"].path)
    assert sorted((tuple(r) for r in gold.collect()), key=str) == sorted(GOLD_EDGE, key=str)
    # rerun: overwrite, same rows
    again = run_pipeline(spark, src, out, ref, run_id="manual__2026-01-01T00:00:00+00:00")
    assert {k: v.rows for k, v in again.items()} == {k: v.rows for k, v in layers.items()}


def test_message_path_replay_and_incremental(spark, tmp_path, edge_frame):
    src, ref = _write_inputs(spark, tmp_path, edge_frame)
    topic = FileTopic(str(tmp_path / "topic"))
    publish(edge_frame, topic)
    replay = run_message_path(spark, topic, str(tmp_path / "b"), ref)
    gold = read_layer(spark, replay["gold"].path)
    assert sorted((tuple(r) for r in gold.collect()), key=str) == sorted(GOLD_EDGE, key=str)

    ckpt = str(tmp_path / "ckpt")
    inc = run_message_path(spark, topic, str(tmp_path / "i"), ref, schema=edge_frame.schema,
                           incremental=True, checkpoint=ckpt)
    assert inc["bronze"].rows == len(EDGE_ROWS) and inc["gold"].rows == 4
    rerun = run_message_path(spark, topic, str(tmp_path / "i"), ref, schema=edge_frame.schema,
                             incremental=True, checkpoint=ckpt)
    # nothing new: nothing added, Gold unchanged
    assert (rerun["bronze"].rows, rerun["silver"].rows, rerun["gold"].rows) == (0, 0, 4)
    gold = read_layer(spark, rerun["gold"].path)
    assert sorted((tuple(r) for r in gold.collect()), key=str) == sorted(GOLD_EDGE, key=str)


def test_incremental_layers_equal_batch_after_new_messages(spark, tmp_path, edge_frame):
    """Run 1 takes the edge rows, run 2 only the new ones; Silver and Gold then
    equal a batch build over everything."""
    from strata.operators.marts import build_gold
    from strata.operators.refine import refine
    from strata.spec import SURVEY, SURVEY_MART
    _, ref = _write_inputs(spark, tmp_path, edge_frame)
    topic = FileTopic(str(tmp_path / "topic"))
    out, ckpt = str(tmp_path / "i"), str(tmp_path / "ckpt")
    publish(edge_frame, topic)
    run_message_path(spark, topic, out, ref, schema=edge_frame.schema, incremental=True,
                     checkpoint=ckpt)
    more = spark.createDataFrame(
        [(1.0, 2.0, 2000.0, 1.0, 3.0, 1.0, "n1"), (66.0, 4.0, 3300.0, 2.0, 3.0, 1.0, "n2"),
         (7.0, 9.0, 2500.0, 1.0, 3.0, 1.0, "dropped")], edge_frame.schema)
    publish(more, topic)
    second = run_message_path(spark, topic, out, ref, schema=edge_frame.schema, incremental=True,
                              checkpoint=ckpt)
    assert (second["bronze"].rows, second["silver"].rows) == (3, 2)
    everything = edge_frame.unionByName(more)
    ref_df = spark.createDataFrame(REFERENCE_ROWS, "state_code int, state_name string")
    want = build_gold(refine(everything, SURVEY), ref_df, SURVEY_MART).collect()
    got = read_layer(spark, second["gold"].path).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)
    assert read_layer(spark, second["silver"].path).count() == 7


def test_incremental_runs_with_new_run_ids_and_silver_counts(spark, tmp_path, edge_frame):
    """Scheduled runs each get a new run id; the incremental layers stay one
    set, and Silver's count is the rows that passed the filter."""
    _, ref = _write_inputs(spark, tmp_path, edge_frame)
    topic = FileTopic(str(tmp_path / "topic"))
    out, ckpt = str(tmp_path / "i"), str(tmp_path / "ckpt")
    publish(edge_frame, topic)
    first = run_message_path(spark, topic, out, ref, schema=edge_frame.schema, incremental=True,
                             checkpoint=ckpt, run_id="r1")
    assert (first["bronze"].rows, first["silver"].rows, first["gold"].rows) == (9, 5, 4)
    second = run_message_path(spark, topic, out, ref, schema=edge_frame.schema,
                              incremental=True, checkpoint=ckpt, run_id="r2")
    assert (second["bronze"].rows, second["silver"].rows, second["gold"].rows) == (0, 0, 4)
    assert first["gold"].path == second["gold"].path


def test_incremental_first_run_on_empty_topic_reports_zero(spark, tmp_path, edge_frame):
    _, ref = _write_inputs(spark, tmp_path, edge_frame)
    topic = FileTopic(str(tmp_path / "topic"))
    publish(edge_frame.limit(0), topic)
    layers = run_message_path(spark, topic, str(tmp_path / "i"), ref, schema=edge_frame.schema,
                              incremental=True, checkpoint=str(tmp_path / "ck"))
    assert (layers["bronze"].rows, layers["silver"].rows, layers["gold"].rows) == (0, 0, 0)


def test_incremental_without_schema_infers_once(spark, tmp_path, edge_frame):
    from tests.conftest import NAN_ROW, SURVEY_SCHEMA
    _, ref = _write_inputs(spark, tmp_path, edge_frame)
    topic = FileTopic(str(tmp_path / "topic"))
    publish(edge_frame.unionByName(spark.createDataFrame([NAN_ROW], SURVEY_SCHEMA)), topic)
    out, ckpt = str(tmp_path / "i"), str(tmp_path / "ck")
    first = run_message_path(spark, topic, out, ref, incremental=True, checkpoint=ckpt)
    # NaN measure normalised to NULL: same Gold as the edge rows alone
    gold = read_layer(spark, first["gold"].path)
    assert sorted((tuple(r) for r in gold.collect()), key=str) == sorted(GOLD_EDGE, key=str)
    stored = spark.read.text(ckpt + "/payload_schema").first().value
    assert '"_BMI5"' in stored and '"double"' in stored
    publish(edge_frame.limit(1), topic)
    second = run_message_path(spark, topic, out, ref, incremental=True, checkpoint=ckpt)
    assert second["bronze"].rows == 1


def test_schemaless_incremental_waits_for_first_messages(spark, tmp_path, edge_frame):
    _, ref = _write_inputs(spark, tmp_path, edge_frame)
    topic = FileTopic(str(tmp_path / "topic"))
    publish(edge_frame.limit(0), topic)
    out, ckpt = str(tmp_path / "i"), str(tmp_path / "ck")
    empty = run_message_path(spark, topic, out, ref, incremental=True, checkpoint=ckpt)
    assert {k: v.rows for k, v in empty.items()} == {"bronze": 0, "silver": 0, "gold": 0}
    publish(edge_frame, topic)
    first = run_message_path(spark, topic, out, ref, incremental=True, checkpoint=ckpt)
    assert (first["bronze"].rows, first["silver"].rows, first["gold"].rows) == (9, 5, 4)


def test_schemaless_paths_survive_all_null_fields_and_later_fractions(spark, tmp_path, edge_frame):
    """A field NULL in every first message is added; a later fractional value
    in a field first seen as integer still decodes."""
    from pyspark.sql import functions as F
    _, ref = _write_inputs(spark, tmp_path, edge_frame)
    first = edge_frame.withColumn("_RACE", F.lit(None).cast("double")) \
        .withColumn("_BMI5", F.round("_BMI5").cast("long"))
    topic = FileTopic(str(tmp_path / "topic"))
    publish(first, topic)
    replay = run_message_path(spark, topic, str(tmp_path / "r"), ref)
    assert replay["silver"].rows == 5
    out, ckpt = str(tmp_path / "i"), str(tmp_path / "ck")
    run_message_path(spark, topic, out, ref, incremental=True, checkpoint=ckpt)
    later = spark.createDataFrame([(1.0, 2.0, 2550.5, 1.0, 3.0, 1.0, "late")], edge_frame.schema)
    publish(later, topic)
    second = run_message_path(spark, topic, out, ref, incremental=True, checkpoint=ckpt)
    assert (second["bronze"].rows, second["silver"].rows) == (1, 1)


def test_csv_null_token_and_safe_cast(spark, tmp_path):
    src, ref = tmp_path / "src.csv", tmp_path / "ref.csv"
    src.write_text("_STATE,GENHLTH,_BMI5,_TOTINDA,_AGEG5YR,_RACE\n"
                   "1,1,2512,1,3,1\n1,NA,2000,1,3,1\n2,2,1e9,2,3,1\n")
    ref.write_text("state_code,state_name\n1,A\n2,B\n")
    layers = run_pipeline(spark, str(src), str(tmp_path / "o"), str(ref), null_value="NA",
                          safe_cast=True)
    assert layers["bronze"].rows == 3 and layers["silver"].rows == 2
    gold = {r.State_Code: (r.record_count, r.bmi_mean)
            for r in read_layer(spark, layers["gold"].path).collect()}
    assert gold == {1.0: (1, 25.12), 2.0: (0, None)}


def test_gold_state_partitions_fixed_small(spark, tmp_path, edge_frame):
    """Gold's streaming state uses a few partitions whatever the session's
    shuffle setting, which is left as it was."""
    import glob
    _, ref = _write_inputs(spark, tmp_path, edge_frame)
    topic = FileTopic(str(tmp_path / "topic"))
    publish(edge_frame, topic)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    ckpt = str(tmp_path / "ck")
    run_message_path(spark, topic, str(tmp_path / "i"), ref, schema=edge_frame.schema,
                     incremental=True, checkpoint=ckpt)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    parts = [p for p in glob.glob(ckpt + "/gold/state/0/*") if p.rsplit("/", 1)[1].isdigit()]
    assert len(parts) == 8


def test_incremental_drains_in_bounded_batches(spark, tmp_path, edge_frame):
    from tests.test_marts import GOLD_EDGE as want
    _, ref = _write_inputs(spark, tmp_path, edge_frame)
    topic = FileTopic(str(tmp_path / "topic"))
    for i in range(3):   # three publishes -> several topic files
        publish(edge_frame.limit(3) if i < 2 else edge_frame, topic)
    layers = run_message_path(spark, topic, str(tmp_path / "i"), ref, schema=edge_frame.schema,
                              incremental=True, checkpoint=str(tmp_path / "ck"), max_per_batch=1)
    assert layers["bronze"].rows == 3 + 3 + 9
    assert read_layer(spark, layers["silver"].path).count() == layers["silver"].rows
    assert layers["gold"].rows == len(want)

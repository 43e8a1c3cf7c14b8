"""Registered queries: one per operator family, over the driver's tables.

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame computed
from the whole tables. Queries that exercise a sink write into a fresh folder
under the shared checkpoint folder and return a frame read back from it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.functions.casts import normalize_nan
from strata.functions.decimals import scale_decimal
from strata.functions.json import decode_frame, encode_row
from strata.functions.labels import code_to_label
from strata.operators.commits import RejectedLayer, commit_layer, diff_versions, layer_log, read_version
from strata.operators.layers import layer_path, literal_frame, read_layer, write_layer
from strata.operators.marts import aggregate_by, build_gold, head_rows, lookup_left_join
from strata.operators.quality import (delivery_report, freshness_report, gold_rules, greater_than, not_null, quality_report,
                                      schema_report, unique)
from strata.operators.refine import filter_valid, refine, valid_rows
from strata.operators.state import correction, merge_state, read_state
from strata.plans.jobs import run_bronze, run_bronze_frame, run_bronze_messages, run_layers, run_message_path, run_pipeline
from strata.plans.survey_view import SURVEY_TYPES, reference_frame, survey_frame
from strata.session import shared_dir
from strata.sources.files import read_csv, read_json_lines, read_reference, read_table
from strata.sources.messages import FileTopic, publish, publish_csv, replay_topic
from strata.spec import (GENERAL_HEALTH_LABELS, MESSAGE_ROW_CAP, PHYSICAL_ACTIVITY_DEFAULT,
                         PHYSICAL_ACTIVITY_LABELS, SURVEY, SURVEY_MART, ValidRule)
from strata.streaming.ingest import ingest_evolving, ingest_incremental
from strata.streaming.layers import named_gold

# A scheduler-style run id, made path-safe by the layer writer.
RUN_ID = "scheduled__2026-01-01T00:00:00+00:00"


def _topic_partitions(spark: SparkSession) -> int:
    """Minimum partitions of a published topic: one per core of the cluster."""
    return spark.sparkContext.defaultParallelism


def _silver(spark: SparkSession, sf_dir: str, measure: str = "l_quantity") -> DataFrame:
    return refine(survey_frame(spark, sf_dir, measure), SURVEY)


def state_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey -> Silver -> per-state count and mean, named, ordered."""
    return build_gold(_silver(spark, sf_dir), reference_frame(spark, sf_dir), SURVEY_MART)


def refine_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels, decimal measure, pass-through codes, valid rows only."""
    return _silver(spark, sf_dir)


def label_codes_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code -> label, unmatched and NULL -> NULL."""
    src = survey_frame(spark, sf_dir)
    return src.select("GENHLTH", code_to_label("GENHLTH", GENERAL_HEALTH_LABELS).alias("General_Health"))


def label_codes_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code -> label, unmatched and NULL -> default label."""
    src = survey_frame(spark, sf_dir)
    return src.select("_TOTINDA", code_to_label("_TOTINDA", PHYSICAL_ACTIVITY_LABELS,
                                                PHYSICAL_ACTIVITY_DEFAULT).alias("Physical_Activity_Status"))


def decimal_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cast to decimal(10,2), then / 100 -> decimal(14,6)."""
    cust = read_table(spark, sf_dir, "customer")
    return cust.select("c_custkey", scale_decimal("c_acctbal").alias("acctbal_scaled"))


def valid_rows_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measure present and > 0 (filter reaches the Parquet scan)."""
    cust = read_table(spark, sf_dir, "customer")
    return filter_valid(cust, ValidRule(measure="c_acctbal"))


def state_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group by key, non-null count, mean as double."""
    return aggregate_by(_silver(spark, sf_dir), "State_Code", "BMI_Value")


def lookup_left_join_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier counts per (double) nation code, left join to the
    nation names read from a reference CSV (int key)."""
    ref_csv = shared_dir(spark, "ref-csv")
    read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("state_code"), F.col("n_name").alias("state_name")
    ).write.option("header", True).csv(ref_csv)
    counts = (read_table(spark, sf_dir, "supplier")
              .groupBy(F.col("s_nationkey").cast("double").alias("State_Code"))
              .agg(F.count(F.lit(1)).alias("supplier_count")))
    return lookup_left_join(counts, read_reference(spark, ref_csv), "State_Code",
                            "state_code", "state_name", "State_Name")


def row_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 5,000 orders by key (the message path's cap)."""
    return head_rows(read_table(spark, sf_dir, "orders"), MESSAGE_ROW_CAP, ["o_orderkey"])


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A header CSV with inferred types -> Bronze, every column kept."""
    src = shared_dir(spark, "csv-src")
    read_table(spark, sf_dir, "customer").write.option("header", True).csv(src)
    out = shared_dir(spark, "csv-ingest")
    bronze = run_bronze_frame(read_csv(spark, src, infer=True), out, RUN_ID)
    return read_layer(spark, bronze.path)


def csv_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from one read of the source: types are found by the job that writes Bronze."""
    base = shared_dir(spark, "csv-once")
    read_table(spark, sf_dir, "customer").write.option("header", True).csv(f"{base}/source")
    return read_layer(spark, run_bronze(spark, f"{base}/source", base, RUN_ID, one_pass=True).path)


def layer_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1/K3/S3: write a run-scoped Parquet layer (overwrite) and read it back."""
    out = shared_dir(spark, "roundtrip")
    path = layer_path(out, "bronze", RUN_ID, "orders.parquet")
    write_layer(read_table(spark, sf_dir, "orders"), path, "orders")
    return read_layer(spark, path)


def layer_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4/A5: rows of each written layer, counted inside the writes."""
    out = shared_dir(spark, "metrics")
    bronze = run_bronze_frame(survey_frame(spark, sf_dir), out, RUN_ID)
    layers = run_layers(spark, bronze, out, reference_frame(spark, sf_dir), run_id=RUN_ID)
    rows = [(name, layers[name].rows) for name in ("bronze", "silver", "gold")]
    return literal_frame(spark, rows, StructType([StructField("layer", StringType()),
                                                  StructField("row_count", LongType())]))


def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2/F2: rows -> JSON values -> rows again (timestamps keep microseconds)."""
    events = read_table(spark, sf_dir, "events")
    encoded = events.select(encode_row(events).alias("value"))
    return decode_frame(encoded, events.schema)


def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """decode a JSON text column with a declared schema."""
    events = read_table(spark, sf_dir, "events")
    return events.select("event_id", F.from_json("props", "k bigint", {"mode": "FAILFAST"})["k"].alias("k"))


def jsonl_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines with inferred schema (integers come back as bigint)."""
    src = shared_dir(spark, "jsonl")
    read_table(spark, sf_dir, "customer").write.json(src)
    return read_json_lines(spark, src)


def json_nan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NaN and NULL values through the codec; NaN is normalised to NULL."""
    k = F.col("event_id")
    events = read_table(spark, sf_dir, "events").select("event_id", F.when(k % 7 == 0, F.lit(float("nan")))
                                                        .when(k % 11 == 0, F.lit(None)).otherwise(F.col("value"))
                                                        .alias("value"))
    encoded = events.select(encode_row(events).alias("value"))
    return normalize_nan(decode_frame(encoded, events.schema))


def topic_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bounded, schema-free replay of messages whose fields differ in
    type: ``amount`` is an integer or a fraction, ``tag`` a number, a text or
    NULL, ``nothing`` NULL in all."""
    orders = read_table(spark, sf_dir, "orders")
    key, price, nothing = F.col("o_orderkey"), F.col("o_totalprice"), F.lit(None).cast("string").alias("nothing")
    whole = F.floor(price).cast("long")
    topic = FileTopic(shared_dir(spark, "topic"))
    for rest, amount, tag in ((0, whole, key), (1, price, F.col("o_orderpriority")), (2, whole, F.lit(None).cast("long"))):
        publish(orders.where(key % 3 == rest).select(key.alias("order_id"), amount.alias("amount"), tag.alias("tag"),
                                                     nothing), topic)
    return replay_topic(spark, topic)


def capped_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 5,000 rows, in file order, of several CSV files, published
    and replayed. The files are written in key order."""
    return replay_topic(spark, _publish_head(spark, sf_dir)[0])


def publish_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: the summary of the capped publish."""
    sent = _publish_head(spark, sf_dir)[1]
    return literal_frame(spark, [(sent["records_sent"], sent["chunks"])],
                         StructType([StructField("records_sent", LongType()), StructField("chunks", LongType())]))


def _publish_head(spark: SparkSession, sf_dir: str) -> tuple[FileTopic, dict]:
    base = shared_dir(spark, "capped")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    orders.repartitionByRange(4, "o_orderkey").sortWithinPartitions("o_orderkey") \
        .write.option("header", True).csv(f"{base}/source")
    topic = FileTopic(f"{base}/topic")
    return topic, publish_csv(spark, f"{base}/source", topic, chunk_size=1_000, max_records=MESSAGE_ROW_CAP)


def incremental_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two incremental runs without a declared schema. The second brings a
    new field, ids beyond 2**53 and fractions in a field of integers."""
    base = shared_dir(spark, "evolving")
    orders, key = read_table(spark, sf_dir, "orders"), F.col("o_orderkey")
    topic, bronze = FileTopic(f"{base}/topic"), f"{base}/bronze"
    first = orders.where(key % 2 == 0).select(key.alias("id"), F.floor("o_totalprice").cast("long").alias("amount"),
                                              F.col("o_orderstatus").alias("status"))
    second = orders.where(key % 2 == 1).select((key + (2 ** 53 + 1)).alias("id"), F.col("o_totalprice").alias("amount"),
                                               F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("added"))
    for part in (first, second):
        publish(part, topic)
        ingest_evolving(spark, topic, bronze, f"{base}/_checkpoint")
    return read_layer(spark, bronze)


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental ingest with a checkpoint; a second run adds nothing."""
    events = read_table(spark, sf_dir, "events")
    base = shared_dir(spark, "stream")
    topic = FileTopic(f"{base}/topic")
    publish(events, topic, partitions=_topic_partitions(spark))
    out, ckpt = f"{base}/bronze", f"{base}/_checkpoint"
    ingest_incremental(spark, topic, events.schema, out, ckpt)
    ingest_incremental(spark, topic, events.schema, out, ckpt)  # nothing new: no-op
    return spark.read.parquet(out)


def message_path_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey rows as JSON messages -> replay -> Bronze -> Silver -> Gold."""
    survey = survey_frame(spark, sf_dir)
    base = shared_dir(spark, "message-path")
    topic = FileTopic(f"{base}/topic")
    publish(survey, topic, partitions=_topic_partitions(spark))
    layers = run_message_path(spark, topic, f"{base}/layers", reference_frame(spark, sf_dir),
                              schema=survey.schema, run_id=RUN_ID)
    return read_layer(spark, layers["gold"].path)


def incremental_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C5 incremental: survey messages -> checkpointed Bronze ingest ->
    appended Silver -> Gold from per-key streaming state. A second run, with
    nothing new but other names in the reference, applies those names."""
    survey = survey_frame(spark, sf_dir)
    base = shared_dir(spark, "incremental")
    topic = FileTopic(f"{base}/topic")
    publish(survey, topic, partitions=_topic_partitions(spark))
    args = dict(schema=survey.schema, incremental=True, checkpoint=f"{base}/_checkpoints",
                run_id=RUN_ID)
    ref = reference_frame(spark, sf_dir)
    old = ref.withColumn("state_name", F.concat(F.lit("old "), "state_name"))
    run_message_path(spark, topic, f"{base}/layers", old, **args)
    layers = run_message_path(spark, topic, f"{base}/layers", ref, **args)
    return read_layer(spark, layers["gold"].path)


def csv_path_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: survey rows as CSV -> Bronze (types given, one read) -> Silver -> Gold."""
    base = shared_dir(spark, "csv-path")
    src, ref = f"{base}/source", f"{base}/ref"
    # the source drop arrives as several files, as a large export does
    survey_frame(spark, sf_dir).repartition(_topic_partitions(spark)).write.option("header", True).csv(src)
    reference_frame(spark, sf_dir).write.option("header", True).csv(ref)
    layers = run_pipeline(spark, src, f"{base}/layers", ref, run_id=RUN_ID, infer=False, types=SURVEY_TYPES)
    return read_layer(spark, layers["gold"].path)


def quality_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q4 on two Gold outputs: the survey measure (passes) and a price
    measure whose means fall outside the range (fails). Both come from one
    aggregation and one look-up."""
    survey = survey_frame(spark, sf_dir, more={"_PRICE": "l_extendedprice"})
    subjects = (("gold", "_BMI5"), ("gold_price", "_PRICE"))
    found = []
    for subject, column in subjects:
        valid = valid_rows(ValidRule(measure=column, code="GENHLTH"))
        value = F.when(valid, scale_decimal(column))
        found += [F.count_if(valid).alias(f"{subject}_rows"), F.count(value).alias(f"{subject}_count"),
                  F.mean(value).cast("double").alias(f"{subject}_mean")]
    both = survey.groupBy(F.col("_STATE").cast("double").alias("State_Code")).agg(*found)
    path = shared_dir(spark, "quality")
    write_layer(lookup_left_join(both, reference_frame(spark, sf_dir), "State_Code", "state_code", "state_name",
                                 "State_Name"), path)
    table, reports = read_layer(spark, path), []  # one row a state
    for subject, _ in subjects:
        gold = table.where(F.col(f"{subject}_rows") > 0).select(
            "State_Code", "State_Name", F.col(f"{subject}_count").alias("record_count"),
            F.col(f"{subject}_mean").alias("bmi_mean"))
        reports.append(quality_report(gold, gold_rules()).select(F.lit(subject).alias("subject"), "*"))
    return reports[0].unionByName(reports[1])


def quality_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1, Q2, Q4, failing: repeated nations, missing health codes, balances that are not positive."""
    customers = read_table(spark, sf_dir, "customer")
    return quality_report(customers, [unique("c_nationkey"), greater_than("c_acctbal", 0)]).unionByName(
        quality_report(survey_frame(spark, sf_dir), [not_null("GENHLTH")]))


def unmatched_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers counted by nation, looked up among regions by number; most have no match."""
    counts = aggregate_by(read_table(spark, sf_dir, "customer"), "c_nationkey", "c_acctbal", "customers", "balance_mean")
    return lookup_left_join(counts.select("c_nationkey", "customers"), read_table(spark, sf_dir, "region"),
                            "c_nationkey", "r_regionkey", "r_name", "region_name")


def nested_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """a schema-free replay of nested messages. In ``line`` the total is an integer or a fraction, the
    tag a number or a text, and ``late`` is there in some; ``codes`` is a list of numbers or of texts."""
    orders = read_table(spark, sf_dir, "orders")
    key, price, status = F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_orderstatus")
    topic = FileTopic(shared_dir(spark, "nested"))
    whole = [F.floor(price).cast("long").alias("total"), key.alias("tag")]
    mixed = [price.alias("total"), F.col("o_orderpriority").alias("tag"), status.alias("late")]
    for rest, fields, codes in ((0, whole, F.array(key, key + 1)), (1, mixed, F.array(status))):
        publish(orders.where(key % 2 == rest).select(key.alias("id"), F.struct(*fields).alias("line"), codes.alias("codes")),
                topic)
    rows = replay_topic(spark, topic)
    return rows.select("id", "line.total", "line.tag", "line.late", F.concat_ws("+", "codes").alias("codes"))


def audited_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q5 with K1: a Gold that keeps its contract is published; a later run on prices, whose means are
    out of range, is written, rejected and logged, and readers keep the first. Rows of that, with the
    log's counts."""
    base, reference = shared_dir(spark, "audited"), reference_frame(spark, sf_dir)
    for measure, run_id in (("l_quantity", "first"), ("l_extendedprice", "second")):
        try:
            bronze = run_bronze_frame(survey_frame(spark, sf_dir, measure), base, run_id, audited=True)
            run_layers(spark, bronze, base, reference, run_id=run_id, audited=True)
        except RejectedLayer:
            if run_id == "first":
                raise
    path = layer_path(base, "gold")
    log = layer_log(spark, path).agg(F.count_if("accepted"), F.count_if(~F.col("accepted"))).first()
    return read_layer(spark, path).withColumns({"accepted": F.lit(log[0]), "rejected": F.lit(log[1])})


def guarded_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A replay of an empty topic is stopped by its own write and leaves the Bronze before; a missing
    layer raises. One row a guard: whether it raised, and the rows that readers of the layer have after it."""
    base, orders = shared_dir(spark, "guarded"), read_table(spark, sf_dir, "orders")
    topic, empty = FileTopic(f"{base}/topic"), FileTopic(f"{base}/empty")
    publish(orders, topic)
    publish(orders.limit(0), empty)
    run_bronze_messages(spark, topic, base, orders.schema, required=(), audited=True)
    raised = {"empty_replay": False, "missing_layer": False}
    try:
        run_bronze_messages(spark, empty, base, orders.schema, required=(), audited=True)
    except RejectedLayer:
        raised["empty_replay"] = True
    try:
        read_layer(spark, f"{base}/nothing")
    except FileNotFoundError:
        raised["missing_layer"] = True
    left = read_layer(spark, layer_path(base, "bronze")).agg(F.count(F.lit(1)).alias("n"))
    rows = F.array(*[F.struct(F.lit(g).alias("guard"), F.lit(r).alias("raised"),
                              (F.col("n") if g == "empty_replay" else F.lit(0)).cast("long").alias("rows_left"))
                     for g, r in raised.items()])
    return left.select(F.inline(rows))


def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: two runs' versions of a layer, read by run id and compared by key: the second lacks some
    customers, has others, and changed balances."""
    path, customers = f"{shared_dir(spark, 'snapshots')}/customers", read_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    kept = customers.select("c_custkey", "c_name", "c_acctbal")
    commit_layer(kept.where(key % 7 != 0), path, run_id="first")
    changed = kept.withColumn("c_acctbal", F.when(key % 5 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    commit_layer(changed.where(key % 11 != 0), path, run_id="second")
    found = diff_versions(read_version(spark, path, run_id="first"), read_version(spark, path, run_id="second"), ["c_custkey"])
    return found.select("c_custkey", "change", F.col("old.c_acctbal").alias("old_acctbal"), F.col("new.c_acctbal").alias("new_acctbal"))


def corrected_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold from mergeable state: two batches of Silver rows, one of them sent twice, then a
    correction that takes back the rows of one race code and adds them with half the measure."""
    survey, half = survey_frame(spark, sf_dir), F.col("_AGEG5YR") % 2
    path = shared_dir(spark, "state")
    for batch in (0, 1, 1):
        merge_state(refine(survey.where(half == batch), SURVEY), path, SURVEY_MART, batch)
    wrong = survey.where("_RACE = 3")
    right = wrong.withColumn("_BMI5", F.col("_BMI5") / 2)
    merge_state(correction(refine(wrong, SURVEY), refine(right, SURVEY)), path, SURVEY_MART, 0, "corrections")
    return named_gold(read_state(spark, path, SURVEY_MART), reference_frame(spark, sf_dir))


def schema_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q5: Gold schema against the contract."""
    return schema_report(state_gold(spark, sf_dir))


def freshness_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: a run manifest (order date = source drop, latest ship date = layer
    write) checked against the 5-day delay.

    lineitem is reduced to one row per order before the join (partial
    aggregation map-side), so a hot order key never reaches the join whole.
    """
    written = (read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
               .agg(F.max("l_shipdate").alias("written_at")))
    orders = read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderdate").alias("dropped_at"))
    manifest = orders.join(written, "l_orderkey", "left")
    return freshness_report(manifest, "dropped_at", "written_at")


def delivery_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6: each order as a drop, in the first write at or after it; writes are the months' first ship dates."""
    month = F.trunc("l_shipdate", "month")
    writes = read_table(spark, sf_dir, "lineitem").groupBy(month.alias("m")).agg(F.min("l_shipdate").alias("written_at")) \
        .select(F.date_format("written_at", "yyyy-MM").alias("run_id"), F.lit("gold").alias("layer"), "written_at")
    drops = read_table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").alias("dropped_at"))
    found = delivery_report(drops, writes, now=dt.datetime(2100, 1, 1, tzinfo=dt.timezone.utc))
    return found.select("o_orderkey", "run_id", "delay_seconds", "status")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "state_gold": state_gold,
    "refine_silver": refine_silver,
    "label_codes_null": label_codes_null,
    "label_codes_default": label_codes_default,
    "decimal_scale": decimal_scale,
    "valid_rows_filter": valid_rows_filter,
    "state_aggregate": state_aggregate,
    "lookup_left_join": lookup_left_join_query,
    "row_cap": row_cap,
    "csv_ingest": csv_ingest,
    "csv_one_pass": csv_one_pass,
    "layer_roundtrip": layer_roundtrip,
    "layer_metrics": layer_metrics,
    "json_encode": json_encode,
    "json_decode": json_decode,
    "json_nan": json_nan,
    "jsonl_ingest": jsonl_ingest,
    "topic_replay": topic_replay,
    "capped_publish": capped_publish,
    "publish_summary": publish_summary,
    "stream_ingest": stream_ingest,
    "incremental_evolving": incremental_evolving,
    "message_path_gold": message_path_gold,
    "incremental_gold": incremental_gold,
    "csv_path_gold": csv_path_gold,
    "quality_report": quality_report_query,
    "quality_failures": quality_failures,
    "unmatched_lookup": unmatched_lookup,
    "corrected_gold": corrected_gold,
    "nested_replay": nested_replay,
    "audited_gold": audited_gold,
    "guarded_layers": guarded_layers,
    "snapshot_diff": snapshot_diff,
    "schema_report": schema_report_query,
    "freshness_report": freshness_report_query,
    "delivery_report": delivery_report_query,
}

"""Incremental Silver and Gold with Structured Streaming.

After an incremental Bronze ingest, rebuilding Silver and Gold from the whole
Bronze layer reprocesses every earlier run. Here each run only touches what is
new:

* Silver: a file stream over Bronze (which reads the Bronze sink's commit log,
  so only committed files), or over the landed messages when their schema is
  inferred, refined row by row and appended to Silver.
* Gold: a stateful streaming aggregation over Silver. The state holds one
  (count, sum) per key; each batch writes the small per-key table (complete
  mode; overwrite, so a replayed batch writes the same result). Every run
  then names and orders that table with the reference as it is now.

All queries use ``availableNow`` with their own checkpoints: a rerun with no
new files only renews the names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strata.functions.casts import normalize_nan
from strata.functions.json import decode_value
from strata.operators.files import path_exists
from strata.operators.layers import LayerResult, layer_path, literal_frame, read_layer, write_layer
from strata.operators.marts import DEFAULT_BROADCAST_ROWS, lookup_left_join
from strata.operators.refine import refine
from strata.operators.state import BUCKETS, merge_state, read_state
from strata.sources.messages import TOPIC_SCHEMA
from strata.spec import SURVEY, SURVEY_MART, MartSpec, RefineSpec
from strata.streaming.ingest import (StreamIngestResult, append_stream, file_stream, messages_path,
                                     run_available_now)

# Default partitions of Gold's streaming state (one row per key, see gold_incremental).
GOLD_STATE_PARTITIONS = 8


def refine_incremental(spark: SparkSession, bronze_path: str, bronze_schema: StructType,
                       silver_path: str, checkpoint: str, spec: RefineSpec = SURVEY,
                       max_files: int | None = None, safe_cast: bool = False) -> StreamIngestResult:
    """Append the refined rows of Bronze files not seen before to Silver."""
    rows = file_stream(spark, bronze_schema, max_files).parquet(bronze_path)
    silver = refine(rows, spec, safe_cast=safe_cast).observe("silver_rows", F.count(F.lit(1)).alias("n"))
    return append_stream(spark, silver, silver_path, checkpoint, metric="silver_rows")


def source_numbers(messages: DataFrame, spec: RefineSpec) -> DataFrame:
    """The spec's input columns of each message as numbers: a text that is none, a NaN and a missing
    field are NULL. This does not depend on the payload schema, which may change."""
    names = spec.source_columns()
    row = decode_value("value", StructType([StructField(c, StringType()) for c in names]), mode="PERMISSIVE")
    return normalize_nan(messages.select(row.alias("__row")).where(F.col("__row").isNotNull())
                         .select(*[F.col("__row")[c].try_cast("double").alias(c) for c in names]))


def refine_messages_incremental(spark: SparkSession, raw_path: str, silver_path: str, checkpoint: str,
                                spec: RefineSpec = SURVEY, max_files: int | None = None,
                                safe_cast: bool = False) -> StreamIngestResult:
    """Append the refined rows of landed messages not seen before to Silver."""
    rows = source_numbers(file_stream(spark, TOPIC_SCHEMA, max_files).parquet(raw_path), spec)
    silver = refine(rows, spec, safe_cast=safe_cast).observe("silver_rows", F.count(F.lit(1)).alias("n"))
    return append_stream(spark, silver, silver_path, checkpoint, metric="silver_rows")


def gold_incremental(spark: SparkSession, silver_path: str, silver_schema: StructType,
                     gold_path: str, checkpoint: str, reference: DataFrame,
                     mart: MartSpec = SURVEY_MART,
                     max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                     state_partitions: int = GOLD_STATE_PARTITIONS,
                     max_files: int | None = None) -> LayerResult:
    """Fold new Silver rows into per-key state and write Gold from it.

    ``state_partitions`` is fixed in the checkpoint at first start (state is
    one row per key and arrives partially aggregated; raise it for very many
    keys). It is set on a session of the query's own.
    """
    aggregate = f"{checkpoint}_aggregate"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(aggregate)  # the complete per-key table

    own = spark.newSession()
    own.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
    silver = file_stream(own, silver_schema, max_files).parquet(silver_path)
    state = silver.groupBy(mart.key).agg(
        F.count(mart.measure).alias(mart.count_name),
        F.mean(mart.measure).cast("double").alias(mart.mean_name),
    )
    writer = (state.writeStream.outputMode("complete")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(write_batch)
              .trigger(availableNow=True))
    run_available_now(own, writer.start, aggregate)
    if not path_exists(spark, aggregate):  # no run has seen a Silver file yet
        return LayerResult(path=gold_path, rows=0)
    return write_layer(named_gold(read_layer(spark, aggregate), reference, mart, max_broadcast_rows), gold_path, "gold")


def named_gold(table: DataFrame, reference: DataFrame, mart: MartSpec = SURVEY_MART,
               max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """A per-key table with its names, ordered by key."""
    named = lookup_left_join(table, reference, mart.key, mart.ref_key, mart.ref_value, mart.name_column, max_broadcast_rows)
    return named.select(mart.key, mart.name_column, mart.count_name, mart.mean_name).orderBy(F.col(mart.key).asc_nulls_first())


def merged_state_path(checkpoint_base: str) -> str:
    """Where ``gold_merged`` keeps its state; ``merge_state`` with another source than ``silver`` corrects it."""
    return f"{checkpoint_base}/gold_state"


def gold_merged(spark: SparkSession, silver_path: str, silver_schema: StructType, gold_path: str, checkpoint: str,
                state_path: str, reference: DataFrame, mart: MartSpec = SURVEY_MART,
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, buckets: int = BUCKETS,
                max_files: int | None = None) -> LayerResult:
    """Fold new Silver rows into mergeable state (``strata.operators.state``) and write Gold from it.

    A batch writes the buckets of the keys it holds, not all keys; rows that turn out wrong can be taken
    back from the state. ``buckets`` is fixed by the first run.
    """
    def take(batch: DataFrame, batch_id: int) -> None:
        merge_state(batch, state_path, mart, batch_id, "silver", buckets)

    silver = file_stream(spark, silver_schema, max_files).parquet(silver_path)
    writer = (silver.writeStream.option("checkpointLocation", checkpoint).foreachBatch(take).trigger(availableNow=True))
    run_available_now(spark, writer.start, state_path)
    if not path_exists(spark, f"{state_path}/_state"):  # no run has seen a Silver file yet
        return LayerResult(path=gold_path, rows=0)
    return write_layer(named_gold(read_state(spark, state_path, mart), reference, mart, max_broadcast_rows), gold_path, "gold")


def run_layers_incremental(spark: SparkSession, bronze: LayerResult, bronze_schema: StructType | None,
                           output_dir: str, reference: DataFrame, checkpoint_base: str,
                           spec: RefineSpec = SURVEY, mart: MartSpec = SURVEY_MART,
                           safe_cast: bool = False, max_files: int | None = None,
                           state_partitions: int = GOLD_STATE_PARTITIONS, merged: bool = False) -> dict[str, LayerResult]:
    """Silver and Gold brought up to date with only the new files. ``merged`` keeps Gold's state in
    buckets that can be corrected (``gold_merged``) instead of in the stream; it holds for the life of the layers.

    With a ``bronze_schema`` Silver reads Bronze, without one the landed
    messages. The layers are one continuously maintained set, so their paths
    do not carry a run id (each run's own record is the manifest row). The
    checkpoints and these layers belong together: starting either afresh
    means starting both afresh.
    """
    silver_path = layer_path(output_dir, "silver")
    gold_path = layer_path(output_dir, "gold")
    if bronze_schema is not None:
        silver = refine_incremental(spark, bronze.path, bronze_schema, silver_path, f"{checkpoint_base}/silver",
                                    spec, max_files, safe_cast)
        source = literal_frame(spark, [], bronze_schema)
    else:
        silver = refine_messages_incremental(spark, messages_path(checkpoint_base), silver_path,
                                             f"{checkpoint_base}/silver", spec, max_files, safe_cast)
        source = source_numbers(literal_frame(spark, [], TOPIC_SCHEMA), spec)
    schema = refine(source, spec).schema
    if merged:
        gold = gold_merged(spark, silver_path, schema, gold_path, f"{checkpoint_base}/gold_merged",
                           merged_state_path(checkpoint_base), reference, mart, max_files=max_files)
    else:
        gold = gold_incremental(spark, silver_path, schema, gold_path, f"{checkpoint_base}/gold", reference, mart,
                                state_partitions=state_partitions, max_files=max_files)
    return {"bronze": bronze, "silver": LayerResult(silver_path, silver.observed), "gold": gold}


__all__ = ["refine_incremental", "refine_messages_incremental", "gold_incremental", "gold_merged", "merged_state_path",
           "named_gold", "run_layers_incremental"]

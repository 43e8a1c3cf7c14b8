"""Incremental message ingest with Structured Streaming.

Each run reads only what arrived since the last committed batch and stops
when it has caught up (``trigger(availableNow=True)``): no idle-timeout wait.
Progress lives in the checkpoint folder, and the Parquet file sink commits a
batch's files together with its offsets, so a rerun after a failure neither
loses nor duplicates rows, and a rerun with nothing new is a no-op.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.types import DoubleType, StructField, StructType

from strata.functions.casts import normalize_nan
from strata.functions.json import decode_frame, flag_messages, split_flagged
from strata.operators.files import load_schema, path_exists, store_schema
from strata.operators.parts import append_part, has_part, is_parted
from strata.sources.messages import (NULL_ONLY, TOPIC_SCHEMA, FileTopic, KafkaTopic, infer_message_schema, merge_schemas,
                                     require_kafka)

MESSAGE_SCHEMA = TOPIC_SCHEMA
# A file stream ignores files older than this before the newest one it has seen (Spark's default
# is 7 days): beyond any retention, so late and backfilled files are read.
MAX_FILE_AGE = "36500d"


@dataclass(frozen=True)
class StreamIngestResult:
    path: str
    rows: int          # input rows read by this run
    batches: int       # micro-batches that read something
    observed: int = 0  # sum of the observed metric, when one was named


def _observed(progress, metric: str | None) -> int:
    """The first value of an observed metric in one progress update (a Row)."""
    row = (progress.observedMetrics or {}).get(metric) if metric else None
    return int(row[0] or 0) if row is not None else 0


class _Progress(StreamingQueryListener):
    """Sums the progress of streaming runs by run id.

    ``recentProgress`` keeps only the last 100 updates, so a long
    ``availableNow`` drain would be under-counted; the listener sees every
    batch, and its termination event comes after the run's last progress.
    """

    def __init__(self, metric: str | None = None) -> None:
        super().__init__()
        self.metric = metric
        self.totals: dict[str, list[int]] = {}
        self.finished: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _event(self, run_id: str) -> threading.Event:
        with self._lock:
            return self.finished.setdefault(run_id, threading.Event())

    def onQueryStarted(self, event) -> None:  # noqa: N802 - listener API
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        observed = _observed(p, self.metric)
        with self._lock:
            t = self.totals.setdefault(str(p.runId), [0, 0, 0])
            t[0] += p.numInputRows
            t[1] += 1 if p.numInputRows > 0 else 0
            t[2] += observed

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._event(str(event.runId)).set()


def run_available_now(spark: SparkSession, start: Callable[[], StreamingQuery], output_path: str,
                      metric: str | None = None) -> StreamIngestResult:
    """Start an ``availableNow`` query, wait for it, and total its batches.

    ``metric`` names an observed count (``df.observe(metric, ...)``) whose
    per-batch values are summed into ``StreamIngestResult.observed``.
    """
    listener = _Progress(metric)
    spark.streams.addListener(listener)
    try:
        query = start()
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(f"streaming run failed: {query.exception()}")
        if not listener._event(str(query.runId)).wait(timeout=600):
            raise RuntimeError("the streaming run ended, but its progress events did not arrive: its totals "
                               "are not known (its rows are committed; a rerun adds nothing twice)")
        rows, batches, observed = listener.totals.get(str(query.runId), [0, 0, 0])
    finally:
        spark.streams.removeListener(listener)
    return StreamIngestResult(path=output_path, rows=rows, batches=batches, observed=observed)


def message_stream(spark: SparkSession, source: KafkaTopic | FileTopic,
                   max_per_batch: int | None = None) -> DataFrame:
    """A streaming frame of message values.

    ``max_per_batch`` bounds each micro-batch (offsets for Kafka, files for a
    file topic); ``availableNow`` still drains everything, batch by batch.
    """
    if isinstance(source, KafkaTopic):
        require_kafka(spark)
        reader = (spark.readStream.format("kafka")
                  .option("kafka.bootstrap.servers", source.bootstrap_servers)
                  .option("subscribe", source.topic)
                  .option("startingOffsets", "earliest")
                  .options(**source.options))
        if max_per_batch:
            reader = reader.option("maxOffsetsPerTrigger", str(max_per_batch))
        return reader.load().select(F.col("value").cast("string").alias("value"))
    return file_stream(spark, MESSAGE_SCHEMA, max_per_batch).parquet(source.path)


def file_stream(spark: SparkSession, schema: StructType, max_files: int | None = None):
    """A reader of new files, whatever their age, at most ``max_files`` of them a batch."""
    reader = spark.readStream.schema(schema).option("maxFileAge", MAX_FILE_AGE)
    return reader.option("maxFilesPerTrigger", str(max_files)) if max_files else reader


def refuse_batch_layer(spark: SparkSession, path: str, checkpoint: str) -> None:
    """A batch run's layer cannot be continued by a stream: readers would see the stream's files alone."""
    if path_exists(spark, path) and not path_exists(spark, f"{path}/_spark_metadata") \
            and not path_exists(spark, checkpoint):
        raise ValueError(f"{path} was written by a batch run; write to another folder, or give the batch runs a run id")


def append_stream(spark: SparkSession, rows: DataFrame, path: str, checkpoint: str,
                  metric: str | None = None) -> StreamIngestResult:
    """Append a stream to a Parquet folder until it has caught up."""
    refuse_batch_layer(spark, path, checkpoint)
    writer = (rows.writeStream.format("parquet")
              .option("checkpointLocation", checkpoint)
              .outputMode("append")
              .trigger(availableNow=True))
    return run_available_now(spark, lambda: writer.start(path), path, metric)


def ingest_incremental(spark: SparkSession, source: KafkaTopic | FileTopic, schema: StructType,
                       output_path: str, checkpoint_path: str, normalize: bool = True,
                       max_per_batch: int | None = None) -> StreamIngestResult:
    """Append new messages, decoded with ``schema``, to a Bronze Parquet folder."""
    rows = decode_frame(message_stream(spark, source, max_per_batch), schema)
    return append_stream(spark, normalize_nan(rows) if normalize else rows, output_path, checkpoint_path)


def messages_path(checkpoint: str) -> str:
    """Where ``ingest_evolving`` keeps the raw messages."""
    return f"{checkpoint}/messages"


def ingest_evolving(spark: SparkSession, source: KafkaTopic | FileTopic, output_path: str, checkpoint: str,
                    required: tuple[str, ...] = (), normalize: bool = True, max_per_batch: int | None = None,
                    quarantine_path: str | None = None) -> tuple[StreamIngestResult, StructType | None]:
    """Append new messages to Bronze without a declared schema: ``(result, schema)``.

    Two streams share ``checkpoint``: new messages land as they are in its ``messages`` folder; each batch
    of landed ones is read once for its types, which join the stored payload schema (integers stay
    integers, an integer and a fraction give double, kinds that differ give text, every field ever seen
    stays), and once more to be decoded into a part of Bronze. A new field, and a changed type, only write
    new files: ``read_layer`` reads older parts with NULL for fields they lack and widens their values
    (a number as Spark prints it where text is wanted). ``required`` fields that no message carried yet
    are doubles. A malformed message stops the run; with ``quarantine_path`` it goes there, and stays
    out of Bronze. The result counts the messages that this run landed; the schema is None while there is
    no message.
    """
    raw, schema_path = messages_path(checkpoint), f"{checkpoint}/payload_schema"
    if path_exists(spark, output_path) and not is_parted(spark, output_path):
        raise ValueError(f"{output_path} was not written by evolving runs (a batch run's layer cannot be continued); "
                         "write to another folder")
    landed = append_stream(spark, message_stream(spark, source, max_per_batch), raw, f"{checkpoint}/landing")
    result = StreamIngestResult(output_path, landed.rows, landed.batches)
    if not path_exists(spark, f"{raw}/_spark_metadata"):
        return result, None

    def take(batch: DataFrame, batch_id: int) -> None:
        if has_part(spark, output_path, batch_id):  # committed, but the stream was stopped before it noted that
            return
        have = load_schema(spark, schema_path)
        seen = infer_message_schema(batch, lenient=quarantine_path is not None, keep_null=False)
        known = merge_schemas(have, seen) if have else seen
        if not known.fields:
            return
        if known != have:
            store_schema(spark, known, schema_path)
        # a field that is NULL so far is not written: its type is not known
        typed = StructType([f for f in known.fields if f.metadata != NULL_ONLY]) if \
            any(f.metadata != NULL_ONLY for f in known.fields) else known
        messages = batch.where(F.trim("value") != "")
        rows = split_flagged(flag_messages(messages, typed))[0] if quarantine_path else decode_frame(messages, typed)
        append_part(spark, normalize_nan(rows) if normalize else rows, output_path, batch_id)

    writer = (file_stream(spark, TOPIC_SCHEMA, max_per_batch).parquet(raw).writeStream.foreachBatch(take)
              .option("checkpointLocation", f"{checkpoint}/bronze").trigger(availableNow=True))
    run_available_now(spark, writer.start, raw)
    known = load_schema(spark, schema_path)
    if known is None:
        return result, None
    names = {f.name for f in known.fields if f.metadata != NULL_ONLY}
    fields = [f for f in known.fields if f.name in names or f.name not in required]
    schema = StructType([StructField(f.name, f.dataType) for f in fields]
                        + [StructField(c, DoubleType()) for c in required if c not in names])
    if quarantine_path:
        stream = file_stream(spark, TOPIC_SCHEMA, max_per_batch).parquet(raw)
        append_stream(spark, split_flagged(flag_messages(stream, schema))[1], quarantine_path, f"{checkpoint}/quarantine")
    if load_schema(spark, f"{output_path}/_schema") != schema:
        store_schema(spark, schema, f"{output_path}/_schema")
    return result, schema


def ingest_files_incremental(spark: SparkSession, source_dir: str, schema: StructType,
                             output_path: str, checkpoint_path: str, fmt: str = "parquet",
                             glob: str | None = None, max_files: int | None = None
                             ) -> StreamIngestResult:
    """Same contract for a folder of data files: each run takes the new files."""
    reader = file_stream(spark, schema, max_files).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return append_stream(spark, reader.load(source_dir), output_path, checkpoint_path)

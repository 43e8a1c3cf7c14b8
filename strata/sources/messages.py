"""JSON messages: publish, bounded replay, decode.

A topic is read as a frame with one text column, ``value``. Two carriers:

* ``KafkaTopic`` - Spark's Kafka source and sink (``format("kafka")``). The
  connector jar is not part of this install, so these calls are not
  exercised by the tests here.
* ``FileTopic`` - a folder of Parquet files with a ``value`` column: a file
  drop of messages.

Decoding runs on the executors (``from_json``), never in a driver loop.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DataType, DecimalType, DoubleType, LongType, NullType, StringType, StructField,
                               StructType, VariantType)

from strata.functions.casts import cast_by_name, normalize_nan
from strata.functions.json import decode_frame, encode_row, flag_messages, split_flagged
from strata.functions.kinds import text_types
from strata.operators.layers import ingest_summary, read_layer, write_layer
from strata.operators.marts import head_rows
from strata.operators.quality import require_rows
from strata.session import shared_dir
from strata.sources.files import head_of_files, read_csv

# Publish settings of the source job's producer.
PUBLISH_OPTIONS = {
    "kafka.linger.ms": "50",
    "kafka.batch.size": "65536",
    "kafka.compression.type": "gzip",
}


@dataclass(frozen=True)
class KafkaTopic:
    bootstrap_servers: str
    topic: str
    options: dict[str, str] = field(default_factory=dict)


@dataclass(frozen=True)
class FileTopic:
    path: str


TOPIC_SCHEMA = StructType([StructField("value", StringType())])


def kafka_available(spark: SparkSession) -> bool:
    """True when Spark's Kafka connector is on the classpath."""
    try:
        spark.read.format("kafka").option("kafka.bootstrap.servers", "unused:0") \
            .option("subscribe", "unused").load()
    except Exception as exc:  # noqa: BLE001 - only a missing data source means "absent"
        return "DATA_SOURCE_NOT_FOUND" not in str(exc) and "Failed to find data source" not in str(exc)
    return True


def require_kafka(spark: SparkSession) -> None:
    if not kafka_available(spark):
        raise RuntimeError(
            "Spark's Kafka connector is not on the classpath; add the "
            "spark-sql-kafka package matching this Spark version, or use a FileTopic")


def publish(df: DataFrame, target: KafkaTopic | FileTopic, max_records: int | None = None,
            order_by: list[str] | None = None, partitions: int | None = None) -> dict:
    """Publish rows as JSON messages; returns ``{records_sent, topic, chunks}``.

    ``max_records`` caps the rows sent (the first rows in ``order_by`` order).
    ``partitions`` deals the rows round-robin over that many writing tasks,
    so that a small or unsplittable source is read back in parallel; without
    it the frame is written as it is split. The row count is observed in the
    write itself.
    """
    if max_records is not None:
        df = head_rows(df, max_records, order_by)
    if partitions:
        df = df.repartition(partitions)
    values = df.select(encode_row(df).alias("value"))
    if isinstance(target, KafkaTopic):
        require_kafka(df.sparkSession)
        obs = Observation("publish")
        (values.observe(obs, F.count(F.lit(1)).alias("rows"))
           .write.format("kafka")
           .option("kafka.bootstrap.servers", target.bootstrap_servers)
           .option("topic", target.topic)
           .options(**{**PUBLISH_OPTIONS, **target.options})
           .save())
        return ingest_summary(int(obs.get["rows"]), target.topic)
    return ingest_summary(write_layer(values, target.path, "publish", mode="append").rows, target.path)


def publish_csv(spark: SparkSession, csv_path: str, target: KafkaTopic | FileTopic,
                chunk_size: int = 10_000, max_records: int | None = None,
                partitions: int | None = None, null_value: str | None = None) -> dict:
    """Publish a CSV file's rows as JSON messages, at most ``max_records`` of
    them, taken in file order. ``chunk_size`` only sizes the returned summary
    (the Spark writer batches by itself). With a cap reading stops there, and
    column types are those of the rows that are sent."""
    if max_records is None:
        rows = read_csv(spark, csv_path, null_value=null_value)
    else:
        rows = head_of_files(spark, csv_path, max_records,
                             lambda paths: read_csv(spark, paths, infer=False, null_value=null_value))
        rows = cast_by_name(rows, text_types(rows))
    sent = publish(rows, target, partitions=partitions)
    return ingest_summary(sent["records_sent"], sent["topic"], chunk_size)


def read_topic(spark: SparkSession, source: KafkaTopic | FileTopic) -> DataFrame:
    """Bounded read of a whole topic, earliest to latest, with no idle wait.

    On Kafka each action on the frame asks for the latest offsets anew, so a
    job that needs one fixed set of messages reads the topic in one action
    (as the replays here do). Not verified here: the connector is absent.
    """
    if isinstance(source, KafkaTopic):
        require_kafka(spark)
        return (spark.read.format("kafka")
                .option("kafka.bootstrap.servers", source.bootstrap_servers)
                .option("subscribe", source.topic)
                .option("startingOffsets", "earliest")
                .option("endingOffsets", "latest")
                .options(**source.options)
                .load()
                .select(F.col("value").cast("string").alias("value")))
    return spark.read.schema(TOPIC_SCHEMA).parquet(source.path)


def decode_messages(spark: SparkSession, messages: DataFrame, schema: StructType | None = None,
                    normalize: bool = True, mode: str = "FAILFAST") -> DataFrame:
    """Message values -> rows, parsed in place by ``from_json``.

    Without a schema it is found first, by one aggregation over the values
    (``infer_message_schema``); fields come sorted by name, blank values are
    no messages, objects and lists in a text field lose the blanks between
    their tokens (a bare NaN there is quoted), and nothing is staged, so ``messages`` is read twice: it must
    give the same values both times (a file listing or a landed topic does).
    ``normalize`` turns NaN into NULL so the message path equals the CSV path.
    """
    if schema is None:
        messages = messages.where(F.trim(F.col("value")) != "")
        schema = infer_message_schema(messages)
    rows = decode_frame(messages, schema, mode=mode)
    return normalize_nan(rows) if normalize else rows


# Marks a field that was NULL in every message so far: its type is not known yet.
NULL_ONLY = {"null_only": True}


def _merge_types(a: DataType, b: DataType) -> DataType:
    """The type that holds values of both, as JSON inference over all messages gives it."""
    if a == b:
        return a
    if isinstance(a, StructType) and isinstance(b, StructType):
        return merge_schemas(a, b)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(_merge_types(a.elementType, b.elementType))
    numbers = (LongType, DoubleType, DecimalType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        whole = all(isinstance(t, LongType) or isinstance(t, DecimalType) and t.scale == 0 for t in (a, b))
        return DecimalType(38, 0) if whole else DoubleType()
    return StringType()


def merge_schemas(old: StructType, new: StructType) -> StructType:
    """Fields of both, by name. A number and a text give text; an integer and a
    fraction give double; integers stay integers."""
    fields = {f.name: f for f in old.fields}
    for f in new.fields:
        have = fields.get(f.name)
        if have is None or have.metadata == NULL_ONLY:
            fields[f.name] = f
        elif f.metadata != NULL_ONLY:
            fields[f.name] = StructField(f.name, _merge_types(have.dataType, f.dataType))
    return StructType([fields[n] for n in sorted(fields)])


# A JSON string; what may stand before a number: a field's name, or the opening or comma of a list.
_STRING = r'"(?:[^"\\]|\\.)*+"'
_BEFORE = rf"{_STRING}\s*:\s*|[\[,]\s*"
_AFTER = r"(?=\s*[,}\]])"


def _numbers_by_kind(value: Column) -> Column:
    """JSON text in which fractions carry an exponent and non-finite numbers are fractions.

    A VARIANT keeps a fraction as a decimal without trailing zeros, so 2.0 would look like a whole
    number, and has no NaN. Only the types of the result are used.
    """
    text = F.regexp_replace(value, rf"({_BEFORE})[-+]?(?:NaN|Infinity|INF){_AFTER}", "$10.5")
    return F.regexp_replace(text, rf"((?:{_BEFORE})-?[0-9]+\.[0-9]+){_AFTER}", "$1e0")


def _json_type(found: DataType, keep_null: bool) -> DataType | None:
    """The type that JSON inference gives for a type found in VARIANTs; None for a field without any
    value (an empty object, and with ``keep_null`` off only NULLs). Values of kinds that differ are text."""
    if isinstance(found, StructType):
        inner = [(f.name, _json_type(f.dataType, keep_null)) for f in sorted(found.fields, key=lambda f: f.name)]
        fields = [StructField(name, kind) for name, kind in inner if kind is not None]
        return StructType(fields) if fields else None
    if isinstance(found, ArrayType):
        inner = _json_type(found.elementType, keep_null)
        return ArrayType(inner) if inner is not None else None
    if isinstance(found, NullType):
        return StringType() if keep_null else None
    return StringType() if isinstance(found, VariantType) else found


def infer_message_schema(messages: DataFrame, value_col: str = "value", lenient: bool = False,
                         keep_null: bool = True) -> StructType:
    """The union of all messages' fields and types, by one aggregation (one job, nothing staged).

    An integer and a fraction give double, kinds that differ give text, fields are sorted by name, as
    schema inference over JSON lines has it. Fields that are NULL in all messages are text marked with
    ``NULL_ONLY``; inside objects they are text too, or left out with ``keep_null`` off. Blank values
    are no messages. A malformed message, or one that is no object, stops the job; ``lenient`` passes
    over it. A field given twice in a message has the type of its last value.
    """
    spark = messages.sparkSession
    text = messages.select(F.col(value_col).cast("string").alias("text")).where(F.trim("text") != "")
    parse = F.try_parse_json if lenient else F.parse_json
    twice = "spark.sql.variant.allowDuplicateKeys"  # taken over when the plan is made
    before = spark.conf.get(twice)
    spark.conf.set(twice, "true")
    try:
        parsed = text.select(parse(_numbers_by_kind(F.col("text"))).alias("v"))
        if lenient:
            parsed = parsed.where(F.schema_of_variant("v").startswith("OBJECT"))
        found = parsed.agg(F.schema_of_variant_agg("v")).first()[0]
    finally:
        spark.conf.set(twice, before)
    if found in (None, "VOID"):
        return StructType([])
    if not found.startswith("OBJECT<"):
        raise ValueError(f"messages must be JSON objects, found {found}")
    # the same grammar as a type's text, but for the name of an object; names in backticks stay
    ddl = re.sub(r"(`(?:[^`]|``)*`)|\bOBJECT<", lambda m: m[1] or "STRUCT<", found)
    fields = []
    for f in sorted(StructType.fromDDL(f"found {ddl}")[0].dataType.fields, key=lambda f: f.name):
        typed = _json_type(f.dataType, False)
        if typed is None:
            null = _json_type(f.dataType, True)
            if null is not None:
                fields.append(StructField(f.name, null, True, NULL_ONLY))
        else:
            fields.append(StructField(f.name, _json_type(f.dataType, keep_null)))
    return StructType(fields)


def add_missing_columns(df: DataFrame, required: tuple[str, ...]) -> DataFrame:
    """``required`` columns absent from ``df`` (no message carried them) as NULL doubles."""
    missing = [c for c in required if c not in df.columns]
    return df.select("*", *[F.lit(None).cast("double").alias(c) for c in missing]) if missing else df


def replay_topic(spark: SparkSession, source: KafkaTopic | FileTopic, schema: StructType | None = None,
                 normalize: bool = True, quarantine_path: str | None = None, guard: bool = True) -> DataFrame:
    """Bounded replay of a whole topic to rows; an empty topic raises, or with ``guard`` off gives no
    rows (for a write that checks its own count).

    Without a schema the values are read twice, first for their types; a Kafka topic, which may grow
    meanwhile, is landed once in the shared folder for that. By default a malformed message stops the
    job. With ``quarantine_path``
    (needs ``schema``) the topic is read and parsed once into a staging
    folder; malformed messages are written to the quarantine from there and
    the well-formed ones are returned.
    """
    messages = read_topic(spark, source)
    if schema is None and isinstance(source, KafkaTopic):
        landed = shared_dir(spark, "landed")
        write_layer(messages, landed, "landed")
        messages = read_layer(spark, landed)
    if guard:
        messages = require_rows(messages, f"topic {source}")
    if quarantine_path is None:
        return decode_messages(spark, messages, schema, normalize)
    if schema is None:
        raise ValueError("a quarantine needs a schema")
    staging = shared_dir(spark, "flagged")
    write_layer(flag_messages(messages, schema), staging, "flagged")
    rows, bad = split_flagged(read_layer(spark, staging))
    write_layer(bad, quarantine_path, "quarantine")
    return normalize_nan(rows) if normalize else rows

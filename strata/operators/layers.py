"""Layer writes: run-scoped paths, overwrite Parquet, row counts in the write."""

from __future__ import annotations

import datetime as dt
import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampNTZType, _parse_datatype_string
from pyspark.sql import functions as F

from strata.functions.casts import cast_by_name
from strata.functions.kinds import flagged_types, type_flags
from strata.operators.files import load_schema, path_exists, read_text, store_schema
from strata.operators.parts import is_parted, read_parts

# File names of each layer, as the source job names them, and
# the character replacements that make a scheduler run id path-safe.
LAYER_FILES = {
    "bronze": "raw_data.parquet",
    "silver": "filtered_data.parquet",
    "gold": "aggregated_by_state.parquet",
}
RUN_ID_REPLACEMENTS = ((":", "-"), ("+", ""), ("/", "__"))


def safe_run_id(run_id: str) -> str:
    """Make a scheduler run id safe for a path (and for a consumer group)."""
    for old, new in RUN_ID_REPLACEMENTS:
        run_id = run_id.replace(old, new)
    return run_id


def layer_path(base: str, layer: str, run_id: str | None = None, name: str | None = None) -> str:
    """``<base>[/<safe run id>]/<layer>/<name>``; one snapshot per run."""
    parts = [base.rstrip("/")]
    if run_id:
        parts.append(safe_run_id(run_id))
    parts += [layer, name or LAYER_FILES.get(layer, f"{layer}.parquet")]
    return "/".join(parts)


@dataclass(frozen=True)
class LayerResult:
    path: str
    rows: int


def literal_frame(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A small frame of known rows, built from literals in the JVM.

    ``createDataFrame`` on a Python list goes through a Python RDD, so even a
    one-row write starts Python workers; literals do not. Date and time
    values are passed as ISO text and cast: into a ``timestamp_ntz`` field an
    aware datetime is stored as its UTC wall time (naive ones as they are);
    into a zoned ``timestamp`` field an aware datetime keeps its offset, and a
    naive one is read in the session time zone, as Spark reads such text.
    """
    def lit(value, field):
        if isinstance(value, dt.datetime):
            if value.tzinfo is not None and isinstance(field.dataType, TimestampNTZType):
                # an instant into a zone-free field: store it as UTC wall time
                value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
            value = value.isoformat(sep=" ")   # an aware value keeps its offset
        elif isinstance(value, dt.date):
            value = value.isoformat()
        return F.lit(value).cast(field.dataType).alias(field.name)

    structs = [F.struct(*[lit(v, f) for v, f in zip(row, schema.fields)]) for row in rows]
    if not structs:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name)
                                       for f in schema.fields])
    return spark.range(1).select(F.inline(F.array(*structs)))


def write_layer(df: DataFrame, path: str, name: str = "layer", partition_by: list[str] | None = None,
                mode: str = "overwrite", max_records_per_file: int | None = None) -> LayerResult:
    """Write ``df`` as Parquet and count its rows in the same pass.

    The count comes from an ``Observation`` evaluated by the write job itself,
    so the layer is not computed a second time. Overwrite makes reruns
    repeatable; the file commit protocol makes a lost executor's partial
    files invisible. A folder that an incremental run maintains (it holds a
    streaming sink's log) is refused.
    """
    spark = df.sparkSession
    if mode == "overwrite" and (path_exists(spark, f"{path}/_spark_metadata") or is_parted(spark, path)):
        raise ValueError(f"{path} is kept by incremental runs; write to another folder, or give a run id")
    if mode == "overwrite" and path_exists(spark, f"{path}/log"):
        raise ValueError(f"{path} is kept in audited versions; write to another folder, or commit a version")
    obs = Observation(name)
    writer = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return LayerResult(path=path, rows=int(obs.get["rows"]))


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """Read a written layer; a missing layer raises FileNotFoundError. A layer that keeps its schema
    beside its files (incremental Bronze, whose fields and types follow the messages) is read with it."""
    if not path_exists(spark, path):
        raise FileNotFoundError(f"layer not found: {path}")
    if path_exists(spark, f"{path}/log"):  # kept in versions (see strata.operators.commits)
        version = read_text(spark, f"{path}/_current")
        if version is None:
            raise FileNotFoundError(f"layer not found: {path} (no version was accepted)")
        return spark.read.parquet(f"{path}/runs/{version}")
    schema = load_schema(spark, f"{path}/_schema")
    if schema is not None and is_parted(spark, path):
        return read_parts(spark, path, schema)
    text = load_schema(spark, f"{path}/_text")
    if text is not None:  # its types were found by the job that wrote it
        return cast_by_name(spark.read.schema(text).parquet(path), {f.name: f.dataType for f in schema.fields})
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


def write_text_layer(df: DataFrame, path: str, name: str = "layer") -> LayerResult:
    """Write a frame of text columns and find their types in the same job (``text_types``, observed), so the
    source is read once. The files keep the text; ``read_layer`` casts it to the types found."""
    spark, found = df.sparkSession, Observation(f"{name}-types")
    result = write_layer(df.observe(found, *type_flags(df.columns)), path, name)
    types = flagged_types(df.columns, found.get)
    store_schema(spark, StructType([StructField(c, _parse_datatype_string(types[c])) for c in df.columns]), f"{path}/_schema")
    store_schema(spark, df.schema, f"{path}/_text")
    return result


def ingest_summary(rows: int, target: str, chunk_size: int = 10_000) -> dict:
    """Summary of a publish: rows sent, target and the chunk count it equals."""
    return {"records_sent": rows, "topic": target,
            "chunks": math.ceil(rows / chunk_size) if chunk_size else 0}


# One row per written layer of a run; the freshness rule reads it.
MANIFEST_SCHEMA = StructType([
    StructField("run_id", StringType()), StructField("layer", StringType()),
    StructField("path", StringType()), StructField("row_count", LongType()),
    StructField("dropped_at", TimestampNTZType()), StructField("written_at", TimestampNTZType()),
])


def append_manifest(spark: SparkSession, manifest_path: str, run_id: str,
                    layers: dict[str, LayerResult], dropped_at: dt.datetime,
                    written_at: dt.datetime | None = None) -> None:
    """Append one row per layer of a run (a handful of rows) to the manifest.

    ``dropped_at`` is when the source was delivered (aware, or naive UTC);
    ``written_at`` defaults to now (UTC). Appends are whole-file commits, so a failed run adds nothing.
    """
    if written_at is None:
        written_at = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = [(run_id, name, r.path, r.rows, dropped_at, written_at) for name, r in layers.items()]
    literal_frame(spark, rows, MANIFEST_SCHEMA).coalesce(1).write.mode("append") \
        .parquet(manifest_path)

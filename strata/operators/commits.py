"""Write, audit, publish: a layer's new version becomes readable only if its rules hold.

``<path>/runs/<id>/`` holds the files of each version, ``<path>/log/<id>`` one line on it (accepted or
not, and why), ``<path>/_current`` names the version that readers get and is renamed into place. A
version is written once and never changed, so a rejected or stopped run leaves the old version as it
is, and a reader that has begun keeps its files. Versions stay readable until ``expire_versions``.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, LongType, StringType, StructField, StructType,
                               TimestampType)

from strata.operators.files import delete_path, list_names, path_exists, read_text, write_text
from strata.operators.layers import LayerResult, literal_frame, read_layer, write_layer
from strata.operators.quality import Rule, quality_report, schema_report

LOG_SCHEMA = StructType([
    StructField("version", StringType()), StructField("run_id", StringType()), StructField("rows", LongType()),
    StructField("accepted", BooleanType()), StructField("failed", ArrayType(StringType())),
    StructField("written_at", TimestampType()),
])


class RejectedLayer(ValueError):
    """A version that was written but not published; ``failed`` names what does not hold."""

    def __init__(self, path: str, version: str, failed: list[str]) -> None:
        super().__init__(f"{path}: version {version} is not published: {'; '.join(failed)}")
        self.version, self.failed = version, failed


@dataclass(frozen=True)
class Audit:
    """What a version must fulfil: at least ``min_rows`` rows (counted by the write itself), the rules, and
    the contract's columns ((name, type, nullable) each)."""

    rules: tuple[Rule, ...] = ()
    min_rows: int = 0
    contract: tuple = ()


def is_committed(spark: SparkSession, path: str) -> bool:
    """Whether the layer is kept in versions."""
    return path_exists(spark, f"{path}/log")


def commit_layer(df: DataFrame, path: str, audit: Audit = Audit(), run_id: str = "", name: str = "layer",
                 now: dt.datetime | None = None) -> LayerResult:
    """Write ``df`` as a new version of the layer, audit the written files, and publish it.

    The rows are counted by the job that writes; rules and contract are each one aggregation over the
    written version, not over ``df``. If anything does not hold, the version stays in its folder for
    inspection, the log says so, readers keep the version before, and RejectedLayer is raised. The
    result's path is the layer's; ``read_layer`` follows it to the current version.
    """
    spark = df.sparkSession
    if path_exists(spark, path) and not is_committed(spark, path) and not list_names(spark, f"{path}/runs"):
        raise ValueError(f"{path} is a plain layer; write versions to another folder")
    now = now or dt.datetime.now(dt.timezone.utc)
    version = f"{now:%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    staged = f"{path}/runs/{version}"
    rows = write_layer(df, staged, name).rows
    failed = [f"{rows} rows, {audit.min_rows} needed"] if rows < audit.min_rows else []
    written = spark.read.schema(df.schema).parquet(staged)
    if audit.rules and not failed:
        failed += [f"{r.rule}({r.target}): {r.violations}"
                   for r in quality_report(written, list(audit.rules)).where(~F.col("passed")).collect()]
    if audit.contract:
        failed += [f"column {r.column_name}: {r.actual_type}, {r.null_count} NULL"
                   for r in schema_report(written, audit.contract).where(~F.col("passed")).collect()]
    write_text(spark, f"{path}/log/{version}", json.dumps(
        {"version": version, "run_id": run_id, "rows": rows, "accepted": not failed, "failed": failed,
         "written_at": now.isoformat()}))
    if failed:
        raise RejectedLayer(path, version, failed)
    write_text(spark, f"{path}/_current", version)
    return LayerResult(path, rows)


def layer_log(spark: SparkSession, path: str) -> DataFrame:
    """One row for each version, accepted or not."""
    if not is_committed(spark, path):
        return literal_frame(spark, [], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).json(f"{path}/log")


def read_version(spark: SparkSession, path: str, version: str | None = None, as_of: dt.datetime | None = None,
                 run_id: str | None = None) -> DataFrame:
    """The current version; or the named one; or the last accepted one that was written by ``as_of``, or
    by the run ``run_id``. FileNotFoundError if there is none."""
    if version is None and as_of is None and run_id is None:
        return read_layer(spark, path)
    found = layer_log(spark, path).where("accepted" if version is None else F.col("version") == version)
    if as_of is not None:
        found = found.where(F.col("written_at") <= F.lit(as_of.isoformat()).cast("timestamp"))
    if run_id is not None:
        found = found.where(F.col("run_id") == run_id)
    last = found.agg(F.max("version")).first()[0]  # versions are named by time
    if last is None:
        raise FileNotFoundError(f"no such version of {path}")
    return spark.read.parquet(f"{path}/runs/{last}")


def diff_versions(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """Rows that are not the same in both: the key, ``change`` (added, removed, changed), and the other
    columns of both as ``old`` and ``new`` (structs; NULL where there is no row). Keys must be unique in
    each. NULL keys are keys; a column that only one side has counts as NULL on the other. One join on the
    key; hot keys cannot be, as each is there once."""
    rest = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in key]

    def side(df: DataFrame, name: str) -> DataFrame:
        cells = [F.col(f"`{c}`") if c in df.columns else F.lit(None).alias(c) for c in rest]
        return df.select(F.struct(*[F.col(f"`{k}`") for k in key]).alias(f"{name}_key"),
                         F.struct(*cells).alias(name) if cells else F.struct(F.lit(True).alias("there")).alias(name))

    both = side(old, "old").join(side(new, "new"), F.col("old_key").eqNullSafe(F.col("new_key")), "full_outer")
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed") \
        .when(~F.col("old").eqNullSafe(F.col("new")), "changed")
    return both.withColumn("change", change).where(F.col("change").isNotNull()) \
        .select(F.coalesce("new_key", "old_key").alias("_key"), "change", "old", "new").select("_key.*", "change", "old", "new")


def expire_versions(spark: SparkSession, path: str, keep: int = 3) -> list[str]:
    """Delete the files of all versions but the newest ``keep`` and the current one; the log stays."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    current = read_text(spark, f"{path}/_current")
    gone = [v for v in list_names(spark, f"{path}/runs")[:-keep] if v != current]
    for version in gone:
        delete_path(spark, f"{path}/runs/{version}")
    return gone

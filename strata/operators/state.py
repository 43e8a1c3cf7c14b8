"""Mergeable Gold state: counts and sums by key in hash buckets, changed by signed rows.

Every change is a row with a weight: 1 adds it, -1 takes it back (a correction is both). Changes are
added up by key; only buckets that hold a changed key are written anew, into a folder of the batch.
``<path>/_state`` names the folder of each bucket and the last batch of each source; it is renamed
into place, so readers see all of a batch or nothing, and a replayed batch changes nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, LongType, StructField, StructType

from strata.operators.files import delete_path, list_names, read_text, write_text
from strata.spec import MartSpec

WEIGHT = "__weight"
# Buckets of a new state: each is rewritten as a whole when one of its keys changes.
BUCKETS = 16
# Rows, values that are not NULL, and their sum.
_SUMS = ("__rows", "__count", "__sum")


def signed(rows: DataFrame, weight: int) -> DataFrame:
    """Rows to add (1) or to take back (-1)."""
    return rows.withColumn(WEIGHT, F.lit(weight))


def correction(old: DataFrame, new: DataFrame) -> DataFrame:
    """The change that replaces the rows ``old`` by ``new``."""
    return signed(old, -1).unionByName(signed(new, 1))


def _load(spark: SparkSession, path: str) -> dict:
    text = read_text(spark, f"{path}/_state")
    return json.loads(text) if text else {}


def _state_schema(changes: DataFrame, mart: MartSpec) -> StructType:
    """Sums of decimals are exact decimals, with room for 10^14 rows; of other numbers, doubles."""
    kind = changes.schema[mart.measure].dataType
    total = DecimalType(min(38, kind.precision + 14), kind.scale) if isinstance(kind, DecimalType) else DoubleType()
    return StructType([StructField(mart.key, changes.schema[mart.key].dataType), StructField("__rows", LongType()),
                       StructField("__count", LongType()), StructField("__sum", total)])


def _read(spark: SparkSession, path: str, state: dict, buckets: list[str]) -> DataFrame:
    schema = StructType.fromJson(state["schema"])
    places = [f"{path}/{state['buckets'][b]}" for b in buckets]
    return spark.read.schema(schema).parquet(*places) if places else spark.createDataFrame([], schema)


def merge_state(changes: DataFrame, path: str, mart: MartSpec, batch: int, source: str = "rows",
                buckets: int = BUCKETS) -> list[int]:
    """Apply a batch of changes; returns the buckets that were written.

    ``changes`` has the mart's key and measure, and ``__weight`` unless all rows are added. Batches of a
    source have rising numbers; one that was applied already is passed over. A key whose rows are all
    taken back leaves the state; taking back more than there is raises, and changes nothing. A hot key is
    summed in each task before it moves; the state of a key is one row. ``buckets`` is fixed by the
    first batch. One writer at a time.
    """
    spark = changes.sparkSession
    state = _load(spark, path)
    if batch <= state.get("batches", {}).get(source, -1):
        return []
    if WEIGHT not in changes.columns:
        changes = signed(changes, 1)
    schema = _state_schema(changes, mart)
    if state and StructType.fromJson(state["schema"]) != schema:
        raise ValueError(f"{path} holds {StructType.fromJson(state['schema']).simpleString()}, not {schema.simpleString()}")
    state = state or {"schema": json.loads(schema.json()), "count": buckets, "buckets": {}, "batches": {}}
    weight, value = F.col(WEIGHT), F.col(mart.measure)
    part = value * weight.cast("decimal(10,0)") if isinstance(schema["__sum"].dataType, DecimalType) else value * weight
    deltas = changes.groupBy(mart.key).agg(
        F.sum(weight).cast("long").alias("__rows"), F.sum(F.when(value.isNotNull(), weight).otherwise(0)).cast("long").alias("__count"),
        F.coalesce(F.sum(part), F.lit(0)).cast(schema["__sum"].dataType).alias("__sum"))
    # equal keys are one group whatever the sign of a zero; adding 0.0 lets them have one hash too
    key = F.col(mart.key) + F.lit(0.0) if isinstance(schema[mart.key].dataType, DoubleType) else F.col(mart.key)
    bucket = F.pmod(F.xxhash64(key), F.lit(state["count"])).cast("int")
    folder = f"data/{source}-{batch}-{uuid.uuid4().hex[:8]}"
    deltas.where("__rows != 0 OR __count != 0 OR __sum != 0").withColumn("bucket", bucket) \
        .write.parquet(f"{path}/{folder}/changes")
    deltas = spark.read.parquet(f"{path}/{folder}/changes")
    touched = sorted(r["bucket"] for r in deltas.select("bucket").distinct().collect())  # at most as many as there are buckets
    held = _read(spark, path, state, [str(b) for b in touched if str(b) in state["buckets"]])
    merged = held.withColumn("bucket", bucket).unionByName(deltas).groupBy("bucket", mart.key) \
        .agg(*[F.sum(c).cast(schema[c].dataType).alias(c) for c in _SUMS])
    below = F.raise_error(F.lit(f"{path}: more rows of a key are taken back than there are"))
    merged = merged.withColumn("__rows", F.when((F.col("__rows") >= 0) & (F.col("__count") >= 0), F.col("__rows")).otherwise(below)) \
        .where("__rows != 0")
    if touched:
        merged.repartition(len(touched), "bucket").write.partitionBy("bucket").parquet(f"{path}/{folder}/state")
    there = {int(name.split("=")[1]) for name in list_names(spark, f"{path}/{folder}/state")}
    for b in touched:
        state["buckets"].pop(str(b), None)
        if b in there:
            state["buckets"][str(b)] = f"{folder}/state/bucket={b}"
    state["batches"][source] = batch
    write_text(spark, f"{path}/_state", json.dumps(state))
    return touched


def read_state(spark: SparkSession, path: str, mart: MartSpec) -> DataFrame:
    """Key, count and mean of all keys, as ``aggregate_by`` gives them for the rows that are in."""
    state = _load(spark, path)
    if not state:
        raise FileNotFoundError(f"no state: {path}")
    held = _read(spark, path, state, sorted(state["buckets"], key=int))
    kind = held.schema["__sum"].dataType
    mean = F.try_divide(F.col("__sum"), F.col("__count"))
    if isinstance(kind, DecimalType):
        mean = mean.cast(DecimalType(38, kind.scale + 4))  # as the mean of decimals has it
    return held.select(mart.key, F.col("__count").alias(mart.count_name), mean.cast("double").alias(mart.mean_name))


def expire_state(spark: SparkSession, path: str) -> list[str]:
    """Delete folders of batches that no bucket is read from any more."""
    state = _load(spark, path)
    used = {place.split("/")[1] for place in state.get("buckets", {}).values()}
    gone = [name for name in list_names(spark, f"{path}/data") if name not in used]
    for name in gone:
        delete_path(spark, f"{path}/data/{name}")
    return gone

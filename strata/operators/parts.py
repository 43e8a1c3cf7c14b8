"""Parquet tables whose fields' types may change: parts by type version, merged when read.

``<path>/v<version>/strata_batch=<batch>/`` holds the files of one batch, ``_schemas/<version>`` the
version's fields, ``_parts/<batch>-<version>`` is written last and makes the batch part of the table.
A new field stays in its version (files without it read as NULL); a changed type begins a version, and
only new files are written. Readers see committed batches alone and keep what they have listed: no
file is ever deleted or rewritten.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, LongType, StringType, StructField, StructType

from strata.operators.files import list_names, load_schema, path_exists, store_schema, write_text

BATCH = "strata_batch"


def holds(new: DataType, old: DataType) -> bool:
    """Whether files of type ``old`` can be read as ``new``: equal but for added fields."""
    if isinstance(new, StructType) and isinstance(old, StructType):
        have = {f.name: f.dataType for f in new.fields}
        return all(f.name in have and holds(have[f.name], f.dataType) for f in old.fields)
    if isinstance(new, ArrayType) and isinstance(old, ArrayType):
        return holds(new.elementType, old.elementType)
    return new == old


def stored_as(want: DataType, have: DataType) -> DataType:
    """``want`` with the types of ``have`` where that has the field: what the files of an older version are read with."""
    if isinstance(want, StructType) and isinstance(have, StructType):
        old = {f.name: f.dataType for f in have.fields}
        return StructType([StructField(f.name, stored_as(f.dataType, old[f.name]) if f.name in old else f.dataType)
                           for f in want.fields])
    if isinstance(want, ArrayType) and isinstance(have, ArrayType):
        return ArrayType(stored_as(want.elementType, have.elementType))
    return have


def widened(col: Column, have: DataType, want: DataType) -> Column:
    """``col`` of type ``have`` as ``want``; objects and lists become their JSON text where text is wanted."""
    if have == want:
        return col
    if isinstance(have, StructType) and isinstance(want, StructType):
        old = {f.name: f.dataType for f in have.fields}
        fields = [widened(col[f.name], old[f.name], f.dataType).alias(f.name) for f in want.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(have, ArrayType) and isinstance(want, ArrayType):
        return F.transform(col, lambda x: widened(x, have.elementType, want.elementType))
    if isinstance(have, (StructType, ArrayType)) and isinstance(want, StringType):
        return F.to_json(col)
    return col.cast(want)


def is_parted(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/_schemas")


def _parts(spark: SparkSession, path: str) -> dict[int, int]:
    """Version of each committed batch."""
    return {int(b): int(v) for b, v in (name.split("-") for name in list_names(spark, f"{path}/_parts"))}


def has_part(spark: SparkSession, path: str, batch: int) -> bool:
    return batch in _parts(spark, path)


def append_part(spark: SparkSession, df: DataFrame, path: str, batch: int) -> int:
    """Add the rows of ``df`` as batch ``batch``; returns the version. ``df`` has every field known so
    far. A batch that is there already stays as it is, so a replayed batch adds nothing."""
    done = _parts(spark, path)
    if batch in done:
        return done[batch]
    versions = [int(n) for n in list_names(spark, f"{path}/_schemas")]
    version = max(versions, default=0)
    have = load_schema(spark, f"{path}/_schemas/{version}")
    if have is not None and not holds(df.schema, have):
        version, have = version + 1, None
    if have != df.schema:
        store_schema(spark, df.schema, f"{path}/_schemas/{version}")
    df.write.mode("overwrite").parquet(f"{path}/v{version}/{BATCH}={batch}")
    write_text(spark, f"{path}/_parts/{batch}-{version}", "")
    return version


def read_parts(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All committed batches with the fields and types of ``schema``."""
    last: dict[int, int] = {}
    for batch, version in _parts(spark, path).items():
        last[version] = max(batch, last.get(version, -1))
    frames = []
    for version, batch in sorted(last.items()):
        have = load_schema(spark, f"{path}/_schemas/{version}")
        files = stored_as(schema, have)
        read = spark.read.schema(StructType([*files.fields, StructField(BATCH, LongType())])) \
            .parquet(f"{path}/v{version}").where(F.col(BATCH) <= batch)  # a batch after it is still being written
        types = {f.name: f.dataType for f in files.fields}
        frames.append(read.select(*[widened(F.col(f"`{f.name}`"), types[f.name], f.dataType).alias(f.name)
                                    for f in schema.fields]))
    if not frames:
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    return reduce(DataFrame.unionByName, frames)

"""Shared pieces of the corpus operators: stored tables, salted prefix sums, frames from rows."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import strata
from strata.session import shared_dir

#: Words of the contracts: runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Salts of a prefix sum: a group's rows are summed in this many parts.
PARTS = 1024


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application (Spark's file server copies it)."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    top = os.path.dirname(os.path.abspath(strata.__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="strata-"), "strata.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def _give_back(run):
    """``run``, after which the worker returns freed memory to the system: workers live on, and what one stage
    has freed would else count against the executor in all later ones."""
    def ended(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL("libc.so.6").malloc_trim(0)
            except (OSError, AttributeError):  # another C library
                pass
    return ended


def map_arrow(df: DataFrame, run, schema, give_back: bool = False) -> DataFrame:
    """``mapInArrow`` with this package at hand in the workers; ``give_back`` frees their memory after a task."""
    ship(df.sparkSession)
    return df.mapInArrow(_give_back(run) if give_back else run, schema)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole documents table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_notes: ContextVar[list[str] | None] = ContextVar("notes", default=None)


@contextmanager
def noting(paths: list[str]) -> Iterator[None]:
    """Within it, and in this thread, ``stored`` adds the folders it writes to ``paths``."""
    before = _notes.set(paths)
    try:
        yield
    finally:
        _notes.reset(before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the cluster's shared folder and read it back.

    Cuts the lineage: what follows restarts from the files if executors are lost,
    and row ids drawn while writing stay as they are.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    if (paths := _notes.get()) is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def prefix_sum(df: DataFrame, groups: list[str], order: list[str], value: Column | str, out: str,
               parts: int = PARTS, dealt: list[str] | None = None) -> DataFrame:
    """Add ``out``: the sum of ``value`` over the rows of the group that come before.

    Rows of a group are dealt by a hash of the ``order`` columns (or of ``dealt``) to ``parts`` parts,
    summed by window inside a part, and moved by the parts' running totals (one row per
    group and part). The order inside a group is (part, order columns): the same on every
    rerun, and no group is ever gathered in one task. ``df`` is read twice: pass a stored
    frame. Group columns must not be NULL.
    """
    value = F.col(value) if isinstance(value, str) else value
    df = df.withColumn("_part", F.pmod(F.xxhash64(*(dealt or order)), F.lit(parts)).cast("int")) \
        .withColumn("_value", value.cast("long"))
    keys = [*groups, "_part"]
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ahead = (Window.partitionBy(*groups) if groups else Window.partitionBy()) \
        .orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys).agg(F.sum("_value").alias("_total"))
    totals = totals.select(*keys, F.coalesce(F.sum("_total").over(ahead), F.lit(0)).alias("_ahead"))
    return (df.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
            .join(totals, keys)
            .withColumn(out, F.col("_ahead") + F.col("_inside"))
            .drop("_part", "_value", "_inside", "_ahead"))


def row_ids(df: DataFrame, name: str = "_row") -> DataFrame:
    """Number the rows; store the frame before the numbers are used twice."""
    return df.withColumn(name, F.monotonically_increasing_id())


def numbered(docs: DataFrame, name: str, *more: Column) -> DataFrame:
    """(_row, _id, _text) of the rows of ``docs``, and ``more``, stored: every pass reads the same numbers,
    whatever the splits of ``docs`` are by then."""
    return stored(docs.select(F.monotonically_increasing_id().alias("_row"), F.col("doc_id").cast("long").alias("_id"),
                              F.col("text").alias("_text"), *more), name)

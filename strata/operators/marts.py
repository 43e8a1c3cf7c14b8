"""Silver -> Gold: keyed aggregation and reference lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from strata.spec import MartSpec

# A lookup side is broadcast only when it is measured (one parallel
# aggregation) to hold at most this many rows and bytes; beyond that the join
# shuffles, with AQE skew handling splitting hot keys.
DEFAULT_BROADCAST_ROWS = 2_000_000
DEFAULT_BROADCAST_BYTES = 128 * 1024 * 1024


def broadcast_size(df: DataFrame) -> tuple[int, int]:
    """``(rows, estimated bytes)`` of ``df`` from one parallel aggregation.

    Fixed-width columns count 8 bytes each plus 16 per row; strings and
    binaries count their real byte length; nested values the length of their
    JSON text. (``limit(n + 1).count()`` would look cheaper but is planned as
    a global limit behind a single-partition exchange, funnelling up to
    tasks x n rows through one task.)
    """
    fixed, var = 0, []
    for f in df.schema.fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            var.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)))
        elif isinstance(f.dataType, (ArrayType, MapType, StructType)):
            var.append(F.coalesce(F.octet_length(F.to_json(F.col(f.name))), F.lit(0)))
        else:
            fixed += 1
    width = sum(var[1:], var[0]) if var else F.lit(0)
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 F.coalesce(F.sum(width), F.lit(0)).cast("long").alias("v")).first()
    rows = int(row.n)
    return rows, rows * (16 + 8 * fixed) + int(row.v)


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes."""
    rows, size = broadcast_size(df)
    return rows <= max_rows and size <= max_bytes


def sized_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                    max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Mark ``df`` for broadcast only when its measured size is within bounds."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def aggregate_by(df: DataFrame, key: str, measure: str,
                 count_name: str = "record_count", mean_name: str = "bmi_mean") -> DataFrame:
    """Per key: non-null count of the measure and its mean as double.

    Spark plans a partial aggregate before the shuffle, so a hot key (even a
    third of all rows) is reduced to one row per task before it moves.
    NULL and NaN keys each form one group; -0.0 and 0.0 are one group.
    """
    return df.groupBy(key).agg(
        F.count(measure).alias(count_name),
        F.mean(measure).cast("double").alias(mean_name),
    )


def lookup_side(reference: DataFrame, key_type, ref_key: str, ref_value: str,
                out_value: str) -> DataFrame:
    """The (key, value) lookup side, key cast to ``key_type`` and renamed so
    names that differ only by case cannot be ambiguous."""
    return reference.select(
        F.col(ref_key).cast(key_type).alias("__ref_key"),
        F.col(ref_value).alias(out_value),
    )


def prepare_lookup(reference: DataFrame, key_type, ref_key: str, ref_value: str,
                   out_value: str, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``lookup_side``, marked for broadcast when its measured size allows."""
    return sized_broadcast(lookup_side(reference, key_type, ref_key, ref_value, out_value),
                           max_broadcast_rows)


def join_prepared(facts: DataFrame, prepared: DataFrame, fact_key: str) -> DataFrame:
    """Left outer join of ``facts`` to a ``prepare_lookup`` result."""
    return facts.join(prepared, facts[fact_key] == prepared["__ref_key"], "left").drop("__ref_key")


def lookup_left_join(facts: DataFrame, reference: DataFrame, fact_key: str, ref_key: str,
                     ref_value: str, out_value: str,
                     max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Left outer equi-join of ``facts`` to a (key, value) reference.

    The reference key is cast to the fact key's type (an int reference against
    a double key). Unmatched or NULL keys get a NULL value; duplicate reference
    keys fan out, as any left join does.
    """
    prepared = prepare_lookup(reference, facts.schema[fact_key].dataType, ref_key, ref_value,
                              out_value, max_broadcast_rows)
    return join_prepared(facts, prepared, fact_key)


def build_gold(silver: DataFrame, reference: DataFrame, spec: MartSpec,
               max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Aggregate by key, attach the reference name, order by key (NULLs first).

    Aggregating before the join means the lookup sees one row per key; the
    only earlier sort in the source job sits under the join and is dropped.
    """
    agg = aggregate_by(silver, spec.key, spec.measure, spec.count_name, spec.mean_name)
    named = lookup_left_join(agg, reference, spec.key, spec.ref_key, spec.ref_value,
                             spec.name_column, max_broadcast_rows)
    return named.select(spec.key, spec.name_column, spec.count_name, spec.mean_name) \
        .orderBy(F.col(spec.key).asc_nulls_first())


def head_rows(df: DataFrame, n: int | None, order_by: list | None = None) -> DataFrame:
    """At most ``n`` rows; ``None`` = all, ``0`` = none.

    With ``order_by`` the rows are the first ``n`` in that order (ties broken
    arbitrarily, as any limit does): Spark's top-n keeps ``n`` rows in each
    task and merges those, so ``n`` is meant to be a small cap (the message
    path's is 5,000). A bare limit has no order guarantee on a distributed
    scan.
    """
    if n is None:
        return df
    if n < 0:
        raise ValueError("n must be >= 0 or None")
    return (df.orderBy(*order_by) if order_by else df).limit(n)

"""Declared quality rules, evaluated as one Spark aggregation.

Each rule is a (name, target, violation-count expression) triple. All rules of
a report are computed by a single ``agg`` over the data and come back as rows
``(rule, target, violations, passed)``; nothing is collected to the driver.
"""

from __future__ import annotations

import datetime as dt
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DataType, DateType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, StringType, TimestampNTZType, TimestampType)

from strata.spec import BMI_MEAN_RANGE, GOLD_CONTRACT, MAX_DELAY_DAYS


@dataclass(frozen=True)
class Rule:
    name: str
    target: str
    violations: Column


# The rules' names, as the contract has them.
UNIQUE = "ExpectColumnValuesToBeUnique"
NOT_NULL = "ExpectColumnValuesNotToBeNull"
BETWEEN = "ExpectColumnValuesToBeBetween"
GREATER_THAN = "ExpectColumnValuesToBeGreaterThan"
DELIVERY = "ExpectDeliveryWithinDays"


def unique(col: str) -> Rule:
    """Non-null values are distinct: count(k) - count(distinct k) = 0."""
    return Rule(UNIQUE, col,
                F.count(col) - F.count_distinct(col))


def not_null(col: str) -> Rule:
    return Rule(NOT_NULL, col, F.count_if(F.col(col).isNull()))


def between(col: str, low: float, high: float) -> Rule:
    """Values in [low, high]; NULLs are left to the not-null rule."""
    return Rule(BETWEEN, col,
                F.count_if(~F.col(col).between(low, high)))


def greater_than(col: str, bound: float) -> Rule:
    return Rule(GREATER_THAN, col,
                F.count_if(~(F.col(col) > bound)))


def gold_rules() -> list[Rule]:
    """The Gold contract's four rules."""
    low, high = BMI_MEAN_RANGE
    return [
        unique("State_Code"),
        not_null("bmi_mean"),
        between("bmi_mean", low, high),
        greater_than("record_count", 0),
    ]


def quality_report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One aggregation over ``df``, then one row per rule."""
    agg = df.agg(*[r.violations.cast("long").alias(f"__v{i}") for i, r in enumerate(rules)])
    rows = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.target).alias("target"),
                 F.col(f"__v{i}").alias("violations"))
        for i, r in enumerate(rules)
    ])
    return agg.select(F.inline(rows)).select(
        "rule", "target", "violations", (F.col("violations") == 0).alias("passed"))


# Contract type names -> Spark types.
_TYPE_NAMES: dict[str, DataType] = {
    "double": DoubleType(),
    "float": FloatType(),
    "string": StringType(),
    "long": LongType(),
    "bigint": LongType(),
    "int": IntegerType(),
    "integer": IntegerType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp": TimestampType(),
    "timestamp_ntz": TimestampNTZType(),
}


def contract_type(type_name: str) -> DataType:
    """Spark type of a contract type name (case-insensitive; decimal(p,s) too)."""
    name = type_name.strip().lower()
    m = re.fullmatch(r"decimal\((\d+)\s*,\s*(\d+)\)", name)
    if m:
        return DecimalType(int(m.group(1)), int(m.group(2)))
    if name not in _TYPE_NAMES:
        raise ValueError(f"unknown contract type {type_name!r}")
    return _TYPE_NAMES[name]


def schema_report(df: DataFrame, contract=GOLD_CONTRACT) -> DataFrame:
    """Schema conformance: name present, type equal, nullability honoured.

    Parquet reads every column back as nullable, so nullability is checked on
    the data: a non-nullable column must have no NULL. Null counts for all
    columns come from one aggregation.
    """
    fields = {f.name: f for f in df.schema.fields}
    # null counts by position, so repeated or dotted names cannot clash
    aggs = [F.count_if(df["`" + name.replace("`", "``") + "`"].isNull()).alias(f"__n{i}")
            for i, (name, _, _) in enumerate(contract) if name in fields]
    counts = df.agg(*aggs) if aggs else df.agg(F.count(F.lit(1)).alias("__rows"))
    rows = []
    for i, (name, type_name, nullable) in enumerate(contract):
        field = fields.get(name)
        actual = field.dataType.simpleString() if field else None
        type_ok = field is not None and field.dataType == contract_type(type_name)
        nulls = F.col(f"__n{i}").cast("long") if field is not None else F.lit(None).cast("long")
        null_ok = F.lit(True) if nullable else (F.coalesce(nulls, F.lit(0)) == 0)
        rows.append(F.struct(
            F.lit(name).alias("column_name"),
            F.lit(type_name).alias("expected_type"),
            F.lit(actual).cast("string").alias("actual_type"),
            F.lit(nullable).alias("nullable"),
            nulls.alias("null_count"),
            (F.lit(type_ok) & null_ok).alias("passed"),
        ))
    return counts.select(F.inline(F.array(*rows)))


def freshness_report(manifest: DataFrame, drop_col: str, written_col: str,
                     max_delay_days: float = MAX_DELAY_DAYS) -> DataFrame:
    """Freshness rule over a run manifest (one row per run).

    A run violates the rule when its layer was written more than
    ``max_delay_days`` x 24 h after its source drop (elapsed time, not
    calendar days), or has no write time. ``max_delay_days`` in the output is
    the largest delay in (fractional) days.
    """
    seconds = F.timestamp_diff("SECOND", F.col(drop_col), F.col(written_col))
    limit = int(round(max_delay_days * 86400))   # whole seconds: 7 h is 25200, exactly
    bound = f"{limit // 86400}d" if limit % 86400 == 0 else f"{limit / 3600:g}h"
    late = F.count_if(F.coalesce(seconds > limit, F.lit(True)))
    return manifest.agg(
        F.lit(DELIVERY).alias("rule"),
        F.lit(f"{written_col}-{drop_col}<={bound}").alias("target"),
        F.count(F.lit(1)).alias("runs"),
        late.cast("long").alias("violations"),
        (F.max(seconds) / F.lit(86400.0)).alias("max_delay_days"),
    ).withColumn("passed", F.col("violations") == 0)


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """Raise when ``df`` is empty (a replay that found no messages)."""
    if df.isEmpty():
        raise RuntimeError(f"no rows found in {what}")
    return df


def run_freshness(manifest: DataFrame, layer: str = "gold",
                  max_delay_days: float = MAX_DELAY_DAYS) -> DataFrame:
    """Freshness of every run in a manifest, judged on one layer's write."""
    runs = manifest.filter(F.col("layer") == layer)
    return freshness_report(runs, "dropped_at", "written_at", max_delay_days)


def source_files(spark: SparkSession, path: str) -> DataFrame:
    """(file, dropped_at) of a source's files, from the file system's own modification times. The scan asks
    for no content, so none is read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path) \
        .select(F.col("path").alias("file"), F.col("modificationTime").alias("dropped_at"))


def delivery_report(drops: DataFrame, manifest: DataFrame, layer: str = "gold", now: dt.datetime | None = None,
                    max_delay_days: float = MAX_DELAY_DAYS) -> DataFrame:
    """Freshness of every drop: (its columns), run_id, written_at, delay_seconds, status.

    ``drops`` has dropped_at; ``manifest`` has run_id, layer and written_at. A drop is in the first write of the
    layer at or after it (an as-of join). Status: ``on_time``; ``late`` beyond ``max_delay_days`` x 24 h;
    ``missing`` if no write followed and that time has passed by ``now``; else ``pending``. A drop without a
    time is ``missing``. The writes' intervals are cut into days and joined by day, so neither side is
    gathered; writes at the same time are one (its least run id). There is one row a drop, in any order.
    """
    seconds = int(round(max_delay_days * 86400))
    drops = drops.withColumn("_day", F.to_date("dropped_at"))
    first = drops.agg(F.min("_day")).first()[0]
    writes = manifest.where((F.col("layer") == layer) & F.col("written_at").isNotNull()) \
        .groupBy("written_at").agg(F.min("run_id").alias("run_id"))
    # one row a run: numbered in one task
    spans = writes.withColumn("_since", F.lag("written_at").over(Window.orderBy("written_at")))
    begin, end = F.greatest(F.to_date("_since"), F.lit(first).cast("date")), F.to_date("written_at")
    spans = spans.where(end >= F.lit(first).cast("date")).withColumn("_day", F.explode(F.sequence(begin, end)))
    inside = (F.col("d._day") == F.col("w._day")) & (F.col("dropped_at") <= F.col("written_at")) \
        & (F.col("_since").isNull() | (F.col("dropped_at") > F.col("_since")))
    found = drops.alias("d").join(spans.alias("w"), inside, "left").drop("_day", "_since")
    late = F.timestamp_diff("SECOND", F.col("dropped_at"), F.col("written_at"))
    moment = F.lit((now or dt.datetime.now(dt.timezone.utc)).isoformat()).cast("timestamp")
    waited = F.timestamp_diff("SECOND", F.col("dropped_at"), moment)
    status = F.when(F.col("written_at").isNotNull(), F.when(late > seconds, "late").otherwise("on_time")) \
        .when(waited <= seconds, "pending").otherwise("missing")
    return found.select(*[c for c in drops.columns if c != "_day"], "run_id", "written_at", late.alias("delay_seconds"),
                        status.alias("status"))

"""Row <-> JSON message expressions."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructField, StructType

CORRUPT_COLUMN = "_corrupt_record"

# Written timestamps keep microseconds (Spark's default writes milliseconds)
# and, for zoned ones, offset seconds (historical zones have them).
# Reading uses Spark's default parsing, which accepts these and the other
# ISO-8601 forms (with or without fraction, 'T' or space, zone for zoned
# timestamps).
# NULL fields are written, so a message carries every column of its row.
ENCODE_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXXXX",
}


def _float_member(name: str) -> Column:
    """``"name":value`` for a float field.

    NaN and infinities are written bare (``NaN``, ``Infinity``) the way a
    Python JSON producer writes them, so schema inference keeps the field
    numeric; a typed decode reads them either way.
    """
    col = F.col(name)
    text = (F.when(col.isNull(), F.lit("null"))
             .when(F.isnan(col), F.lit("NaN"))
             .when(col == float("inf"), F.lit("Infinity"))
             .when(col == float("-inf"), F.lit("-Infinity"))
             .otherwise(col.cast("string")))
    return F.concat(F.lit(json.dumps(name) + ":"), text)


def _member(name: str, opts: dict) -> Column:
    """``"name":value`` of one non-float field via ``to_json``."""
    one = F.to_json(F.struct(F.col(name)), opts)
    return F.substring(one, F.lit(2), F.length(one) - 2)   # drop the braces


def encode_row(df: DataFrame, columns: list[str] | None = None,
               options: dict[str, str] | None = None) -> Column:
    """One JSON object per row of ``df``; NULL fields are written as ``null``.

    Rows are written by ``to_json``. A row with a non-finite value in a
    top-level float field (rare; tested on the columns) is built member by
    member instead, that value bare, as the source job's producer writes it,
    so schema inference keeps the field numeric.
    """
    names = columns or df.columns
    types = {f.name: f.dataType for f in df.schema.fields}
    opts = {**ENCODE_OPTIONS, **(options or {})}
    plain = F.to_json(F.struct(*[F.col(c) for c in names]), opts)
    floats = [n for n in names if isinstance(types[n], (DoubleType, FloatType))]
    if not floats:
        return plain
    odd = F.lit(False)
    for n in floats:
        c = F.col(n)
        odd = odd | F.coalesce(F.isnan(c) | (c == float("inf")) | (c == float("-inf")), F.lit(False))
    parts = [_float_member(n) if n in floats else _member(n, opts) for n in names]
    exact = F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    return F.when(odd, exact).otherwise(plain)


def decode_value(value: Column | str, schema: StructType, mode: str = "FAILFAST",
                 options: dict[str, str] | None = None) -> Column:
    """Parse a JSON (text or UTF-8 binary) value to a struct.

    ``FAILFAST`` stops the job on a malformed message, as the source job
    does; ``PERMISSIVE`` gives a NULL struct instead (a quarantine can then
    keep the raw value).
    """
    col = F.col(value) if isinstance(value, str) else value
    return F.from_json(col.cast("string"), schema, {"mode": mode, **(options or {})})


def decode_frame(messages: DataFrame, schema: StructType, value_col: str = "value",
                 mode: str = "FAILFAST") -> DataFrame:
    """Decode a message frame into one column per schema field."""
    return messages.select(decode_value(value_col, schema, mode).alias("__row")).select("__row.*")


def flag_messages(messages: DataFrame, schema: StructType, value_col: str = "value") -> DataFrame:
    """Each message with its parsed row (``__row``) and its raw text (``__raw``). A malformed message
    keeps its text in the row's ``_corrupt_record``. Store this frame before splitting it, so that
    both parts come from one read of the topic."""
    with_corrupt = StructType(schema.fields + [StructField(CORRUPT_COLUMN, StringType())])
    raw = F.col(value_col).cast("string")
    return messages.select(
        F.from_json(raw, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COLUMN}).alias("__row"),
        raw.alias("__raw"))


def split_flagged(flagged: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """``(rows, quarantined)`` of a ``flag_messages`` frame."""
    bad = F.col(f"__row.{CORRUPT_COLUMN}").isNotNull() | F.col("__row").isNull()
    return (flagged.filter(~bad).select("__row.*").drop(CORRUPT_COLUMN),
            flagged.filter(bad).select(F.col("__raw").alias(value_col)))

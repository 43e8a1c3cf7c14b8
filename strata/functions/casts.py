"""Casts applied by column name (never by position)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType


def cast_by_name(df: DataFrame, types: dict[str, str | DataType]) -> DataFrame:
    """Cast the named columns, keep the others and the column order.

    A CSV schema given to the reader is applied by position, which silently
    shifts columns when the header differs; reading everything and casting by
    name here cannot.
    """
    missing = [c for c in types if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found for cast: {missing}")
    return df.select(*[
        df[f"`{c}`"].cast(types[c]).alias(c) if c in types else df[f"`{c}`"] for c in df.columns
    ])


def normalize_nan(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every float/double column.

    JSON messages carry a missing number as a bare ``NaN`` while the CSV
    path reads it as NULL; normalising makes both paths give equal layers.
    """
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            out.append(F.nanvl(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)

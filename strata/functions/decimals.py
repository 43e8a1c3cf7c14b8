"""Decimal scaling: raw x100 measures to exact decimals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def scale_decimal(value: Column | str, precision: int = 10, scale: int = 2,
                  divisor: int = 100, safe: bool = False) -> Column:
    """``cast(value as decimal(p, s)) / divisor``.

    The cast rounds half up. With ``divisor`` an integer literal the result
    of decimal(10,2) / 100 is decimal(14,6). Under ANSI mode (the default)
    a value out of range raises; ``safe=True`` uses ``try_cast`` and gives
    NULL instead. NaN gives NULL either way.
    """
    col = F.col(value) if isinstance(value, str) else value
    target = f"decimal({precision},{scale})"
    casted = col.try_cast(target) if safe else col.cast(target)
    return casted / F.lit(divisor)

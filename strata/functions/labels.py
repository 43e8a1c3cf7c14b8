"""Code -> label expressions (CASE WHEN chains, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def code_to_label(code: Column | str, labels: dict[int, str], default: str | None = None) -> Column:
    """``CASE WHEN code = k1 THEN v1 ... [ELSE default] END``.

    Equality is numeric, so 1, 1.0 and '1'-cast values all match; NULL, NaN
    and unlisted codes take no branch and give ``default`` (NULL when None).
    """
    col = F.col(code) if isinstance(code, str) else code
    items = list(labels.items())
    if not items:
        return F.lit(default)
    expr = F.when(col == items[0][0], items[0][1])
    for value, label in items[1:]:
        expr = expr.when(col == value, label)
    if default is not None:
        expr = expr.otherwise(default)
    return expr

"""Types of text columns, found by aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def text_types(df: DataFrame) -> dict[str, str]:
    """The type of each text column, by one aggregation: int, bigint, decimal without fraction, double,
    boolean, date, timestamp or string, the narrowest that all its values have, as CSV inference finds it
    (but ``1f`` and ``2d`` are text, not numbers). A column without values is a string."""
    found = df.agg(*type_flags(df.columns)).first()
    return flagged_types(df.columns, found)


_KINDS = ("int", "bigint", "decimal", "double", "boolean", "date", "timestamp")


def type_flags(columns: list[str]) -> list[Column]:
    """Aggregates for ``flagged_types``: for each column whether all its values have each type, and the
    digits of its longest whole number. They can be observed in a job that does something else."""
    out = []
    for k, name in enumerate(columns):
        c = F.col(f"`{name}`")
        whole = c.rlike(r"^[+-]?[0-9]+$")
        tests = {
            "int": whole & c.try_cast("int").isNotNull(),
            "bigint": whole & c.try_cast("bigint").isNotNull(),
            "decimal": whole & c.try_cast("decimal(38,0)").isNotNull(),
            "double": c.try_cast("double").isNotNull() & ~c.rlike(r"(?i)[a-df-z]") | c.isin("NaN", "Inf", "-Inf"),
            "boolean": F.lower(c).isin("true", "false"),
            "date": c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & c.try_cast("date").isNotNull(),
            "timestamp": c.rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}([T ][0-9:]+.*)?$") & c.try_cast("timestamp").isNotNull(),
        }
        out += [F.coalesce(F.bool_and(F.when(c.isNotNull(), tests[kind])), F.lit(False)).alias(f"{kind}_{k}") for kind in _KINDS]
        out.append(F.max(F.when(whole, F.length(F.regexp_replace(c, "^[+-]?0*", "")))).alias(f"digits_{k}"))
    return out


def flagged_types(columns: list[str], found) -> dict[str, str]:
    """Column types from the values of ``type_flags`` (a Row or a dict)."""
    types = {}
    for k, name in enumerate(columns):
        kind = next((kind for kind in _KINDS if found[f"{kind}_{k}"]), "string")
        types[name] = f"decimal({found[f'digits_{k}']},0)" if kind == "decimal" else kind
    return types

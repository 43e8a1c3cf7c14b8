"""Survey-shaped input built from the driver's tables.

The driver ships no survey file, so a wide coded record is derived from
``lineitem`` joined to ``supplier``, with missing values injected the way a
real survey has them:

=============  ==================================================================
``_STATE``     supplier nation as double; NULL where l_orderkey % 29 = 0
``GENHLTH``    line number 1-7 as double (6, 7 are invalid); NULL where % 17 = 0
``_BMI5``      measure x 100; NULL where l_orderkey % 19 = 0, 0 where % 23 = 0
``_TOTINDA``   round(l_tax * 100): 0-8, only 1 and 2 have labels
``_AGEG5YR``   l_quantity as int
``_RACE``      round(l_discount * 100)
``RETFLAG``    an extra column: Bronze keeps it, Silver drops it
=============  ==================================================================

The reference table is ``nation`` as ``(state_code, state_name)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.marts import sized_broadcast
from strata.sources.files import read_table


# Types of the survey's numeric columns, for a CSV read in one pass.
SURVEY_TYPES = {c: "double" for c in ("_STATE", "GENHLTH", "_BMI5", "_TOTINDA", "_AGEG5YR", "_RACE")}


def survey_frame(spark: SparkSession, sf_dir: str, measure: str = "l_quantity",
                 more: dict[str, str] | None = None) -> DataFrame:
    """Wide coded rows, one per lineitem (all rows, no sampling). ``more`` adds
    further measure columns, made like ``_BMI5``: name -> source column."""
    li = read_table(spark, sf_dir, "lineitem")
    su = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # supplier is a dimension: broadcast it only when its size is proven
    # small; otherwise a shuffle join, whose hot keys AQE splits.
    joined = li.join(sized_broadcast(su), li["l_suppkey"] == su["s_suppkey"])
    k = F.col("l_orderkey")
    null = F.lit(None)

    def scaled(column: str):
        return F.when(k % 19 == 0, null).when(k % 23 == 0, F.lit(0.0)).otherwise(F.col(column) * 100)

    return joined.select(
        F.when(k % 29 == 0, null).otherwise(F.col("s_nationkey").cast("double")).alias("_STATE"),
        F.when(k % 17 == 0, null).otherwise(F.col("l_linenumber").cast("double")).alias("GENHLTH"),
        scaled(measure).alias("_BMI5"),
        F.round(F.col("l_tax") * 100).cast("int").alias("_TOTINDA"),
        F.col("l_quantity").cast("int").alias("_AGEG5YR"),
        F.round(F.col("l_discount") * 100).cast("int").alias("_RACE"),
        F.col("l_returnflag").alias("RETFLAG"),
        *[scaled(c).alias(name) for name, c in (more or {}).items()],
    )


def reference_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code -> name reference: every nation."""
    return read_table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("state_code"), F.col("n_name").alias("state_name"))

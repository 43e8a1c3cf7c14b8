"""Equivalent SQL for each registered query, for an independent engine.

Written for DuckDB over the driver's tables (registered as views). Decimal
arithmetic is kept exact: x / 100 is written as x * 0.01 in decimals, and
Spark's ``avg(decimal(14,6))`` -> ``decimal(18,10)`` (half-up) -> double is
computed on scaled integers.
"""

from __future__ import annotations

# CTE: the survey-shaped rows (see strata.plans.survey_view).
def _survey_cte(measure: str = "l_quantity") -> str:
    return f"""
  SELECT
    CASE WHEN l.l_orderkey % 29 = 0 THEN NULL ELSE CAST(s.s_nationkey AS DOUBLE) END AS "_STATE",
    CASE WHEN l.l_orderkey % 17 = 0 THEN NULL ELSE CAST(l.l_linenumber AS DOUBLE) END AS "GENHLTH",
    CASE WHEN l.l_orderkey % 19 = 0 THEN NULL
         WHEN l.l_orderkey % 23 = 0 THEN CAST(0 AS DOUBLE)
         ELSE l.{measure} * 100 END AS "_BMI5",
    CAST(round(l.l_tax * 100) AS INTEGER) AS "_TOTINDA",
    CAST(trunc(l.l_quantity) AS INTEGER) AS "_AGEG5YR",
    CAST(round(l.l_discount * 100) AS INTEGER) AS "_RACE",
    l.l_returnflag AS "RETFLAG"
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey"""


_GENERAL_HEALTH_CASE = """CASE WHEN "GENHLTH" = 1 THEN 'Excellent' WHEN "GENHLTH" = 2 THEN 'Very Good'
         WHEN "GENHLTH" = 3 THEN 'Good' WHEN "GENHLTH" = 4 THEN 'Fair'
         WHEN "GENHLTH" = 5 THEN 'Poor' END"""

_ACTIVITY_CASE = """CASE WHEN "_TOTINDA" = 1 THEN 'Active' WHEN "_TOTINDA" = 2 THEN 'Inactive'
         ELSE 'Unknown' END"""


def _scaled(expr: str) -> str:
    """cast(x as decimal(10,2)) / 100 as an exact decimal(14,6)."""
    return f"CAST(CAST({expr} AS DECIMAL(10,2)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(14,6))"


def _silver_cte(survey: str = "survey") -> str:
    return f"""
  SELECT
    CAST("_STATE" AS DOUBLE) AS State_Code,
    {_GENERAL_HEALTH_CASE} AS General_Health,
    {_scaled('"_BMI5"')} AS BMI_Value,
    {_ACTIVITY_CASE} AS Physical_Activity_Status,
    CAST("_AGEG5YR" AS DOUBLE) AS Age_Group_Code,
    CAST("_RACE" AS DOUBLE) AS Race_Code
  FROM {survey}
  WHERE "GENHLTH" <= 5 AND "_BMI5" IS NOT NULL AND "_BMI5" > 0"""


def _mean(col: str) -> str:
    """Spark avg(decimal(14,6)) cast to double, on exact integers:
    round_half_up(sum * 1e4 / count) / 1e10 (all means here are >= 0)."""
    s = f"CAST(sum({col}) * 1000000 AS HUGEINT)"
    n = f"NULLIF(count({col}), 0)"
    return f"CAST(({s} * 20000 + {n}) // (2 * {n}) AS DOUBLE) / 10000000000.0"


def _agg_cte(silver: str = "silver") -> str:
    return f"""
  SELECT State_Code, count(BMI_Value) AS record_count, {_mean('BMI_Value')} AS bmi_mean
  FROM {silver} GROUP BY State_Code"""


def _gold_cte(agg: str = "agg") -> str:
    return f"""
  SELECT a.State_Code, n.n_name AS State_Name, a.record_count, a.bmi_mean
  FROM {agg} a LEFT JOIN nation n ON a.State_Code = CAST(n.n_nationkey AS DOUBLE)"""


def _with(*ctes: tuple[str, str]) -> str:
    return "WITH " + ",\n".join(f"{name} AS ({body}\n)" for name, body in ctes)


_SURVEY_TO_GOLD = _with(("survey", _survey_cte()), ("silver", _silver_cte()),
                        ("agg", _agg_cte()), ("gold", _gold_cte()))

_GOLD_SQL = _SURVEY_TO_GOLD + "\nSELECT * FROM gold ORDER BY State_Code NULLS FIRST"


def _quality_rows(subject: str, gold: str) -> str:
    rules = [
        ("ExpectColumnValuesToBeUnique", "State_Code", "count(State_Code) - count(DISTINCT State_Code)"),
        ("ExpectColumnValuesNotToBeNull", "bmi_mean", "count_if(bmi_mean IS NULL)"),
        ("ExpectColumnValuesToBeBetween", "bmi_mean", "count_if(NOT (bmi_mean BETWEEN 15.0 AND 45.0))"),
        ("ExpectColumnValuesToBeGreaterThan", "record_count", "count_if(NOT (record_count > 0))"),
    ]
    parts = [
        f"SELECT '{subject}' AS subject, '{rule}' AS rule, '{target}' AS target, "
        f"CAST({expr} AS BIGINT) AS violations, CAST({expr} AS BIGINT) = 0 AS passed FROM {gold}"
        for rule, target, expr in rules
    ]
    return "\nUNION ALL\n".join(parts)


_QUALITY_SQL = _with(
    ("survey", _survey_cte()), ("silver", _silver_cte()), ("agg", _agg_cte()), ("gold", _gold_cte()),
    ("survey_p", _survey_cte("l_extendedprice")), ("silver_p", _silver_cte("survey_p")),
    ("agg_p", _agg_cte("silver_p")), ("gold_p", _gold_cte("agg_p")),
) + "\n" + _quality_rows("gold", "gold") + "\nUNION ALL\n" + _quality_rows("gold_price", "gold_p")


def _schema_rows() -> str:
    rows = [
        ("State_Code", "double", "double", True),
        ("State_Name", "string", "string", True),
        ("record_count", "long", "bigint", False),
        ("bmi_mean", "double", "double", True),
    ]
    parts = []
    for name, expected, actual, nullable in rows:
        nulls = f"CAST(count_if({name} IS NULL) AS BIGINT)"
        passed = "true" if nullable else f"{nulls} = 0"
        parts.append(
            f"SELECT '{name}' AS column_name, '{expected}' AS expected_type, '{actual}' AS actual_type, "
            f"{str(nullable).lower()} AS nullable, {nulls} AS null_count, {passed} AS passed FROM gold")
    return "\nUNION ALL\n".join(parts)


# elapsed whole seconds, truncated like Spark's timestamp_diff
_DELAY = "(epoch_us(written_at) - epoch_us(dropped_at)) // 1000000"

ORACLE_SQL: dict[str, str] = {
    "state_gold": _GOLD_SQL,
    "refine_silver": _with(("survey", _survey_cte()), ("silver", _silver_cte())) + "\nSELECT * FROM silver",
    "label_codes_null": _with(("survey", _survey_cte()))
    + f'\nSELECT "GENHLTH", {_GENERAL_HEALTH_CASE} AS General_Health FROM survey',
    "label_codes_default": _with(("survey", _survey_cte()))
    + f'\nSELECT "_TOTINDA", {_ACTIVITY_CASE} AS Physical_Activity_Status FROM survey',
    "decimal_scale": f"SELECT c_custkey, {_scaled('c_acctbal')} AS acctbal_scaled FROM customer",
    "valid_rows_filter": "SELECT * FROM customer WHERE c_acctbal IS NOT NULL AND c_acctbal > 0",
    "state_aggregate": _with(("survey", _survey_cte()), ("silver", _silver_cte()), ("agg", _agg_cte()))
    + "\nSELECT * FROM agg",
    "lookup_left_join": """
WITH counts AS (
  SELECT CAST(s_nationkey AS DOUBLE) AS State_Code, count(*) AS supplier_count
  FROM supplier GROUP BY 1)
SELECT c.State_Code, c.supplier_count, n.n_name AS State_Name
FROM counts c LEFT JOIN nation n ON c.State_Code = CAST(n.n_nationkey AS DOUBLE)""",
    "row_cap": "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5000",
    "csv_ingest": """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer""",
    "csv_one_pass": """
SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
FROM customer""",
    "layer_roundtrip": "SELECT * FROM orders",
    "layer_metrics": _SURVEY_TO_GOLD + """
SELECT 'bronze' AS layer, count(*) AS row_count FROM survey
UNION ALL SELECT 'silver' AS layer, count(*) AS row_count FROM silver
UNION ALL SELECT 'gold' AS layer, count(*) AS row_count FROM gold""",
    "json_encode": "SELECT * FROM events",
    "json_decode": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "jsonl_ingest": """
SELECT c_acctbal, CAST(c_custkey AS BIGINT) AS c_custkey, c_mktsegment, c_name,
       CAST(c_nationkey AS BIGINT) AS c_nationkey
FROM customer""",
    "json_nan": """
SELECT event_id, CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN NULL ELSE value END AS value FROM events""",
    "topic_replay": """
SELECT o_orderkey AS order_id,
       CASE WHEN o_orderkey % 3 = 1 THEN o_totalprice ELSE floor(o_totalprice) END AS amount,
       CASE o_orderkey % 3 WHEN 0 THEN CAST(o_orderkey AS VARCHAR) WHEN 1 THEN o_orderpriority END AS tag,
       CAST(NULL AS VARCHAR) AS nothing
FROM orders""",
    "capped_publish": """
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5000""",
    "publish_summary": """
SELECT least(count(*), 5000) AS records_sent, CAST(ceil(least(count(*), 5000) / 1000.0) AS BIGINT) AS chunks
FROM orders""",
    "incremental_evolving": """
SELECT CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority END AS added,
       CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice ELSE floor(o_totalprice) END AS amount,
       CASE WHEN o_orderkey % 2 = 1 THEN o_orderkey + 9007199254740993 ELSE o_orderkey END AS id,
       o_orderstatus AS status
FROM orders""",
    "stream_ingest": "SELECT * FROM events",
    "message_path_gold": _GOLD_SQL,
    "incremental_gold": _GOLD_SQL,
    "csv_path_gold": _GOLD_SQL,
    "quality_report": _QUALITY_SQL,
    "quality_failures": _with(("survey", _survey_cte())) + """
SELECT 'ExpectColumnValuesToBeUnique' AS rule, 'c_nationkey' AS target,
       count(c_nationkey) - count(DISTINCT c_nationkey) AS violations,
       count(c_nationkey) = count(DISTINCT c_nationkey) AS passed FROM customer
UNION ALL
SELECT 'ExpectColumnValuesToBeGreaterThan', 'c_acctbal', CAST(count_if(NOT (c_acctbal > 0)) AS BIGINT),
       count_if(NOT (c_acctbal > 0)) = 0 FROM customer
UNION ALL
SELECT 'ExpectColumnValuesNotToBeNull', 'GENHLTH', CAST(count_if("GENHLTH" IS NULL) AS BIGINT),
       count_if("GENHLTH" IS NULL) = 0 FROM survey""",
    "unmatched_lookup": """
SELECT c.c_nationkey, c.customers, r_name AS region_name
FROM (SELECT c_nationkey, count(c_acctbal) AS customers FROM customer GROUP BY c_nationkey) c
LEFT JOIN region ON c.c_nationkey = r_regionkey""",
    "corrected_gold": _with(
        ("before", _survey_cte()),
        ("survey", """
  SELECT * REPLACE (CASE WHEN "_RACE" = 3 THEN "_BMI5" / 2 ELSE "_BMI5" END AS "_BMI5") FROM before"""),
        ("silver", _silver_cte()), ("agg", _agg_cte()), ("gold", _gold_cte())) + "\nSELECT * FROM gold",
    "nested_replay": """
SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice ELSE floor(o_totalprice) END AS total,
       CASE WHEN o_orderkey % 2 = 1 THEN o_orderpriority ELSE CAST(o_orderkey AS VARCHAR) END AS tag,
       CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus END AS late,
       CASE WHEN o_orderkey % 2 = 1 THEN o_orderstatus
            ELSE CAST(o_orderkey AS VARCHAR) || '+' || CAST(o_orderkey + 1 AS VARCHAR) END AS codes
FROM orders""",
    "audited_gold": _SURVEY_TO_GOLD + """
SELECT *, CAST(1 AS BIGINT) AS accepted, CAST(1 AS BIGINT) AS rejected FROM gold""",
    "guarded_layers": """
SELECT 'empty_replay' AS guard, true AS raised, count(*) AS rows_left FROM orders
UNION ALL SELECT 'missing_layer', true, CAST(0 AS BIGINT)""",
    "snapshot_diff": """
WITH a AS (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 7 <> 0),
b AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 5 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal
      FROM customer WHERE c_custkey % 11 <> 0)
SELECT coalesce(a.c_custkey, b.c_custkey) AS c_custkey,
       CASE WHEN a.c_custkey IS NULL THEN 'added' WHEN b.c_custkey IS NULL THEN 'removed' ELSE 'changed' END AS change,
       a.c_acctbal AS old_acctbal, b.c_acctbal AS new_acctbal
FROM a FULL JOIN b ON a.c_custkey = b.c_custkey
WHERE a.c_custkey IS NULL OR b.c_custkey IS NULL OR a.c_acctbal IS DISTINCT FROM b.c_acctbal""",
    "schema_report": _SURVEY_TO_GOLD + "\n" + _schema_rows(),
    "freshness_report": f"""
WITH w AS (SELECT l_orderkey, max(l_shipdate) AS written_at FROM lineitem GROUP BY l_orderkey),
m AS (SELECT o.o_orderdate AS dropped_at, w.written_at
      FROM orders o LEFT JOIN w ON o.o_orderkey = w.l_orderkey)
SELECT 'ExpectDeliveryWithinDays' AS rule, 'written_at-dropped_at<=5d' AS target,
       count(*) AS runs,
       CAST(count_if(coalesce({_DELAY} > 5 * 86400, true)) AS BIGINT) AS violations,
       max({_DELAY}) / 86400.0 AS max_delay_days,
       count_if(coalesce({_DELAY} > 5 * 86400, true)) = 0 AS passed
FROM m""",
    "delivery_report": """
WITH w AS (SELECT strftime(min(l_shipdate), '%Y-%m') AS run_id, min(l_shipdate) AS written_at
           FROM lineitem GROUP BY date_trunc('month', l_shipdate)),
d AS (SELECT o_orderkey, o_orderdate AS dropped_at FROM orders)
SELECT o_orderkey, run_id, (epoch_us(written_at) - epoch_us(dropped_at)) // 1000000 AS delay_seconds,
       CASE WHEN written_at IS NULL THEN 'missing'
            WHEN (epoch_us(written_at) - epoch_us(dropped_at)) // 1000000 > 5 * 86400 THEN 'late' ELSE 'on_time' END AS status
FROM d ASOF LEFT JOIN w ON d.dropped_at <= w.written_at""",
}

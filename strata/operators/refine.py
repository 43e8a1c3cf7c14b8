"""Bronze -> Silver: project, label, scale, validate (narrow, no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.decimals import scale_decimal
from strata.functions.labels import code_to_label
from strata.spec import RefineSpec, ValidRule


def valid_rows(rule: ValidRule) -> Column:
    """Validity predicate on input columns.

    ``code <= max_code`` drops NULL and NaN codes (NaN sorts above every
    number) but keeps 0, negatives and fractions, as the source job does;
    ``min_code`` adds the documented lower bound. ``measure > 0`` drops NULL,
    zero and negatives and keeps NaN.
    """
    measure = F.col(rule.measure)
    cond = measure.isNotNull() & (measure > 0)
    if rule.code is not None:
        code = F.col(rule.code)
        if rule.max_code is not None:
            cond = (code <= rule.max_code) & cond
        if rule.min_code is not None:
            cond = (code >= rule.min_code) & cond
    return cond


def filter_valid(df: DataFrame, rule: ValidRule) -> DataFrame:
    """Keep valid rows; the predicate reaches the Parquet scan as pushed filters."""
    return df.filter(valid_rows(rule))


def refine(df: DataFrame, spec: RefineSpec, validate: bool = True, safe_cast: bool = False) -> DataFrame:
    """Apply a RefineSpec: filter on input columns first, then one projection.

    Filtering before projecting lets the filter use columns the projection
    drops; Catalyst pushes it into the scan either way. Every column is a
    built-in expression, so the whole step is one codegen stage with no
    shuffle.
    """
    if validate and spec.valid is not None:
        df = filter_valid(df, spec.valid)
    exprs: dict[str, Column] = {
        spec.key[1]: F.col(spec.key[0]).cast(spec.code_type),
    }
    for rule in spec.labels:
        exprs[rule.target] = code_to_label(rule.source, rule.labels, rule.default)
    for m in spec.measures:
        exprs[m.target] = scale_decimal(m.source, m.precision, m.scale, m.divisor, safe=safe_cast)
    for source, target in spec.passthrough:
        exprs[target] = F.col(source).cast(spec.code_type)
    return df.select(*[exprs[c].alias(c) for c in spec.output_columns()])

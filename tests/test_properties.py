"""Property tests: Gold counts add up to Silver, one Gold row per key."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st

from strata.operators.marts import build_gold
from strata.operators.refine import refine
from strata.spec import SURVEY, SURVEY_MART
from tests.conftest import SURVEY_SCHEMA

code = st.one_of(st.none(), st.sampled_from([0.0, 1.0, 2.0, 2.5, 5.0, 6.0, 7.0]))
state = st.one_of(st.none(), st.sampled_from([1.0, 2.0, 66.0, 99.0]))
measure = st.one_of(st.none(), st.sampled_from([-5.0, 0.0, 1500.0, 2512.0, 2512.345, 4000.0]))
row = st.tuples(state, code, measure, code, st.just(1.0), st.just(1.0), st.just("x"))


@settings(max_examples=15, deadline=None)
@given(st.lists(row, min_size=0, max_size=30))
def test_gold_adds_up(spark, rows):
    df = spark.createDataFrame(rows, SURVEY_SCHEMA)
    silver = refine(df, SURVEY)
    ref = spark.createDataFrame([(1, "A"), (2, "B")], "state_code int, state_name string")
    gold = build_gold(silver, ref, SURVEY_MART).collect()
    silver_rows = silver.collect()
    assert sum(r.record_count for r in gold) == sum(1 for r in silver_rows if r.BMI_Value is not None)
    assert len(gold) == len({r.State_Code for r in silver_rows})
    for r in gold:
        assert r.record_count > 0 and 15.0 <= r.bmi_mean <= 40.0


def _brute_gold(rows, ref):
    """Silver + Gold by hand: exact decimals, half-up rounding, as Spark does."""
    import math
    from decimal import ROUND_HALF_UP, Decimal, localcontext

    groups: dict = {}
    for state, health, bmi, *_ in rows:
        if health is None or math.isnan(health) or not health <= 5:
            continue
        if bmi is None or not (math.isnan(bmi) or bmi > 0):   # Spark: NaN > 0
            continue
        key = "nan" if state is not None and math.isnan(state) else state
        if isinstance(key, float) and key == 0:
            key = 0.0                                          # -0.0 groups with 0.0
        value = None if math.isnan(bmi) else \
            Decimal(repr(bmi)).quantize(Decimal("0.01"), ROUND_HALF_UP) / 100
        count, total = groups.get(key, (0, Decimal(0)))
        if value is not None:
            count, total = count + 1, total + value
        groups[key] = (count, total)
    out = []
    for key, (count, total) in groups.items():
        with localcontext() as ctx:
            ctx.prec = 60
            mean = None if count == 0 else float(
                (total / count).quantize(Decimal("1e-10"), ROUND_HALF_UP))
        name = ref.get(key) if isinstance(key, float) else None
        out.append((key, name, count, mean))
    return sorted(out, key=str)


measure_brute = st.one_of(st.none(), st.just(float("nan")),
                          st.integers(-500, 500_000).map(lambda i: i / 100),
                          st.integers(1, 5_000_000).map(lambda i: i / 1000))
state_brute = st.one_of(st.none(), st.just(float("nan")), st.sampled_from([1.0, 2.0, 66.0, 99.0, -0.0]))
row_brute = st.tuples(state_brute, st.one_of(code, st.just(float("nan"))), measure_brute, code,
                      st.just(1.0), st.just(1.0), st.just("x"))


@settings(max_examples=12, deadline=None)
@given(st.lists(row_brute, min_size=1, max_size=40))
def test_gold_equals_brute_force(spark, rows):
    import math
    df = spark.createDataFrame(rows, SURVEY_SCHEMA)
    ref_rows = [(1, "A"), (2, "B"), (66, "G")]
    ref = spark.createDataFrame(ref_rows, "state_code int, state_name string")
    got = []
    for r in build_gold(refine(df, SURVEY), ref, SURVEY_MART).collect():
        key = "nan" if r.State_Code is not None and math.isnan(r.State_Code) else r.State_Code
        got.append((key, r.State_Name, r.record_count, r.bmi_mean))
    want = _brute_gold(rows, {float(k): v for k, v in ref_rows})
    assert sorted(got, key=str) == want

"""Declarative specs that drive the refine / aggregate / quality operators.

The operators take these specs instead of hard-coded column names, so the
survey job is just one instance (``SURVEY``) and any wide coded source can be
refined the same way.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------
# Fixed values. These must equal the source job's output exactly.
# --------------------------------------------------------------------------
# General health code -> label; any other code gives NULL.
GENERAL_HEALTH_LABELS = {1: "Excellent", 2: "Very Good", 3: "Good", 4: "Fair", 5: "Poor"}
# Physical activity code -> label; any other code (or NULL) gives the default.
PHYSICAL_ACTIVITY_LABELS = {1: "Active", 2: "Inactive"}
PHYSICAL_ACTIVITY_DEFAULT = "Unknown"
# Raw measure is stored x100; cast to decimal(10,2), then divide by 100.
MEASURE_PRECISION, MEASURE_SCALE, MEASURE_DIVISOR = 10, 2, 100
# Rows are valid when health code <= 5 and the measure is present and > 0.
MAX_VALID_CODE = 5
# Gold contract: column, type, nullable.
GOLD_CONTRACT = (
    ("State_Code", "double", True),
    ("State_Name", "string", True),
    ("record_count", "long", False),
    ("bmi_mean", "double", True),
)
# Gold quality rules: bmi_mean between 15.0 and 45.0 (ends included).
BMI_MEAN_RANGE = (15.0, 45.0)
# Freshness: a layer is written at most 5 days after its source drop.
MAX_DELAY_DAYS = 5
# Message path cap per run (the scheduled message job sends at most this).
MESSAGE_ROW_CAP = 5_000


@dataclass(frozen=True)
class LabelRule:
    """Map an integer-coded column to text labels."""

    source: str
    target: str
    labels: dict[int, str]
    default: str | None = None


@dataclass(frozen=True)
class ScaleRule:
    """``cast(source as decimal(p, s)) / divisor`` -> target."""

    source: str
    target: str
    precision: int = MEASURE_PRECISION
    scale: int = MEASURE_SCALE
    divisor: int = MEASURE_DIVISOR


@dataclass(frozen=True)
class ValidRule:
    """Row filter on *input* columns: code <= max_code (and >= min_code when
    given), measure not null and > 0. ``code`` may be None to check only the
    measure."""

    measure: str
    code: str | None = None
    max_code: float | None = MAX_VALID_CODE
    min_code: float | None = None


@dataclass(frozen=True)
class RefineSpec:
    """Bronze -> Silver: key, labels, scaled measures, pass-through codes."""

    key: tuple[str, str]
    labels: tuple[LabelRule, ...]
    measures: tuple[ScaleRule, ...]
    passthrough: tuple[tuple[str, str], ...] = ()
    valid: ValidRule | None = None
    # Key and pass-through codes are cast to this type by name, so CSV
    # (int or double inferred) and JSON (bigint or double) inputs agree.
    code_type: str = "double"
    # Output column order: as the source job wrote it.
    order: tuple[str, ...] = field(default=())

    def source_columns(self) -> tuple[str, ...]:
        """Input columns the spec reads, in first-use order."""
        cols = [self.key[0]] + [r.source for r in self.labels] + [m.source for m in self.measures]
        cols += [src for src, _ in self.passthrough]
        if self.valid is not None:
            cols += [self.valid.measure] + ([self.valid.code] if self.valid.code else [])
        return tuple(dict.fromkeys(cols))

    def output_columns(self) -> tuple[str, ...]:
        if self.order:
            return self.order
        return (
            (self.key[1],)
            + tuple(r.target for r in self.labels)
            + tuple(m.target for m in self.measures)
            + tuple(t for _, t in self.passthrough)
        )


@dataclass(frozen=True)
class MartSpec:
    """Silver -> Gold: group key, measure, output names, reference lookup."""

    key: str
    measure: str
    count_name: str = "record_count"
    mean_name: str = "bmi_mean"
    ref_key: str = "state_code"
    ref_value: str = "state_name"
    name_column: str = "State_Name"


SURVEY = RefineSpec(
    key=("_STATE", "State_Code"),
    labels=(
        LabelRule("GENHLTH", "General_Health", GENERAL_HEALTH_LABELS),
        LabelRule("_TOTINDA", "Physical_Activity_Status", PHYSICAL_ACTIVITY_LABELS,
                  PHYSICAL_ACTIVITY_DEFAULT),
    ),
    measures=(ScaleRule("_BMI5", "BMI_Value"),),
    passthrough=(("_AGEG5YR", "Age_Group_Code"), ("_RACE", "Race_Code")),
    valid=ValidRule(measure="_BMI5", code="GENHLTH"),
    order=("State_Code", "General_Health", "BMI_Value", "Physical_Activity_Status",
           "Age_Group_Code", "Race_Code"),
)

SURVEY_MART = MartSpec(key="State_Code", measure="BMI_Value")

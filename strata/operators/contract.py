"""Declared data contracts -> quality rules, schema and freshness bound.

A contract is a mapping with ``schema`` (name, type, nullable), a list of
``quality_rules`` (rule, target, condition) and an optional ``SLA.max_delay``
("N days ..."). It can come from a YAML file (when PyYAML is installed), a
JSON file, or a dict. Only the contract text is read on the driver; the rules
it yields are evaluated by ``quality_report`` as one Spark aggregation.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from strata.operators.quality import Rule, between, greater_than, not_null, unique


@dataclass(frozen=True)
class Contract:
    schema: tuple[tuple[str, str, bool], ...]
    rules: tuple[Rule, ...]
    max_delay_days: float | None


def _rule(entry: dict) -> Rule:
    name, target = entry["rule"], entry["target"]
    cond = str(entry.get("condition", "")).strip()
    if name == "ExpectColumnValuesToBeUnique":
        return unique(target)
    if name == "ExpectColumnValuesNotToBeNull":
        return not_null(target)
    if name == "ExpectColumnValuesToBeBetween":
        m = re.fullmatch(r"(-?[\d.]+)\s+AND\s+(-?[\d.]+)", cond, re.IGNORECASE)
        if not m:
            raise ValueError(f"bad range condition: {cond!r}")
        return between(target, float(m.group(1)), float(m.group(2)))
    if name == "ExpectColumnValuesToBeGreaterThan":
        return greater_than(target, float(cond))
    raise ValueError(f"unknown rule: {name}")


_TRUE, _FALSE = {"true", "yes", "1"}, {"false", "no", "0"}
_DELAY_UNITS = {"day": 1.0, "hour": 1 / 24, "week": 7.0}


def _flag(value, what: str) -> bool:
    if isinstance(value, bool):
        return value
    text = str(value).strip().lower()
    if text in _TRUE or text in _FALSE:
        return text in _TRUE
    raise ValueError(f"{what}: not a yes/no value: {value!r}")


def _max_delay_days(text) -> float | None:
    """'5 days after upstream source drop' -> 5.0; hours and weeks too."""
    if text is None or str(text).strip() == "":
        return None
    m = re.match(r"\s*(\d+(?:\.\d+)?)\s*(day|hour|week)s?\b", str(text), re.IGNORECASE)
    if not m:
        raise ValueError(f"SLA.max_delay not understood: {text!r}")
    return float(m.group(1)) * _DELAY_UNITS[m.group(2).lower()]


def parse_contract(doc: dict) -> Contract:
    """Build a Contract from an already-parsed document."""
    from strata.operators.quality import contract_type

    schema = []
    for c in doc.get("schema", []):
        type_name = str(c["type"]).strip().lower()
        contract_type(type_name)   # unknown types fail here, not later
        schema.append((c["name"], type_name, _flag(c.get("nullable", True), c["name"])))
    rules = tuple(_rule(r) for r in doc.get("quality_rules", []))
    delay = _max_delay_days((doc.get("SLA") or {}).get("max_delay"))
    return Contract(schema=tuple(schema), rules=rules, max_delay_days=delay)


def load_contract(path: str) -> Contract:
    """Read a contract file (``.yaml``/``.yml`` needs PyYAML, else JSON)."""
    with open(path, encoding="utf-8") as fh:
        text = fh.read()
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as exc:  # pragma: no cover - depends on the install
            raise RuntimeError("PyYAML is needed to read a YAML contract") from exc
        return parse_contract(yaml.safe_load(text))
    return parse_contract(json.loads(text))

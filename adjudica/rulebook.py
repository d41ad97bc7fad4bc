"""Rules as data: the rule type, a default rulebook, and rules as tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# --- fixed values: condition keys and their kinds, pipeline steps, effects, operators ------------------
KEY_KINDS = {
    "month_in": "num",
    "client_is": "str",
    "km_from_origin": "num",
    "route_touches": "array",
    "route_is_hill": "bool",
    "route_east_of_lucknow": "bool",
    "dest_hub": "str",
    "is_night_dispatch": "bool",
    "driver_months_tenure": "num",
    "vehicle_bs_stage": "str",
    "vehicle_year": "num",
    "vehicle_has_heater": "bool",
    "vehicle_days_past_service": "num",
    "vehicle_brake_work_days": "num",
    "vehicle_has_active_jugaad": "bool",
    "vehicle_last_client_incident": "str",
}
CANDIDATE_KEYS = [k for k in KEY_KINDS if k.startswith("vehicle_")]
STEPS = ["classify", "select_vehicle", "draft_message", "assign_driver"]
EFFECTS = [
    "exclude_vehicle", "exclude_driver", "set_source_hub", "set_sla_hours", "adjust_eta_pct",
    "message_constraint",
]
OPERATORS = ["gt", "gte", "lt", "lte", "eq", "ne"]


@dataclass(frozen=True)
class Rule:
    """One rule. ``when`` maps a key to a list (any of), a dict of comparisons, a boolean, or a value."""

    id: str
    step: str
    priority: int
    when: dict[str, Any]
    effect: str
    quote: str
    value: str | None = None
    reason: str | None = None
    name: str | None = None
    implemented: bool | None = True


def ordered(rules: Sequence[Rule]) -> list[Rule]:
    """Highest priority first, then by id."""
    return sorted(rules, key=lambda r: (-r.priority, r.id))


def active(rules: Sequence[Rule], step: str) -> list[Rule]:
    """The rules of a step that are in force, in order."""
    if step not in STEPS:
        raise ValueError(f"unknown step {step!r}, known: {', '.join(STEPS)}")
    return [r for r in ordered(rules) if r.step == step and r.implemented is not False]


# --- fixed values: the default rulebook (ids, conditions, effects and values) -------------------------
DEFAULT_RULES = [
    Rule("R-SERVICE-OVERDUE-30", "select_vehicle", 100, {"vehicle_days_past_service": {"gt": 30}},
         "exclude_vehicle", "More than thirty days past due means grounded",
         reason="Service is more than 30 days overdue", name="Overdue service"),
    Rule("R-BS4-NCR-WINTER", "select_vehicle", 100,
         {"month_in": [10, 11, 12, 1, 2], "route_touches": ["delhi", "gurgaon", "faridabad", "noida"],
          "vehicle_bs_stage": "BS4"},
         "exclude_vehicle", "No BS4 on a capital-region route from October to February",
         reason="BS4 is barred there in winter", name="No BS4 in the capital region in winter"),
    Rule("R-HILL-HEATER", "select_vehicle", 100,
         {"month_in": [11, 12, 1, 2], "route_is_hill": True, "vehicle_has_heater": False},
         "exclude_vehicle", "A winter hill run needs an engine heater",
         reason="No engine heater for a cold start", name="Heater for winter hill routes"),
    Rule("R-HILL-BRAKE-30", "select_vehicle", 100,
         {"route_is_hill": True, "vehicle_brake_work_days": {"lt": 30}},
         "exclude_vehicle", "No hill run within thirty days of brake work",
         reason="Brake work is less than 30 days old", name="No fresh brake work on hills"),
    Rule("R-JUGAAD-7DAY", "select_vehicle", 100, {"vehicle_has_active_jugaad": True},
         "exclude_vehicle", "A temporary fix is a seven day clock",
         reason="A temporary fix is still open", name="Temporary fix"),
    Rule("R-ORIGIN-50KM", "select_vehicle", 90, {"km_from_origin": {"lte": 50}},
         "set_source_hub", "Within fifty kilometres the origin sends", value="origin",
         reason="Within 50 km of the origin", name="Origin sends when near"),
    Rule("R-ORIGIN-BEYOND-50KM", "select_vehicle", 90, {"km_from_origin": {"gt": 50}},
         "set_source_hub", "Beyond fifty kilometres the nearest able hub sends", value="nearest",
         reason="More than 50 km from the origin", name="Nearest hub when far"),
    Rule("R-SHAKTI-36H", "classify", 50, {"client_is": "shakti_cement"},
         "set_sla_hours", "Thirty-six hours, whatever the contract says", value="36",
         reason="The working limit is 36 hours", name="36-hour client"),
    Rule("R-ORION-NEWEST", "select_vehicle", 50,
         {"client_is": "orion_pharma", "vehicle_year": {"lt": 2020}},
         "exclude_vehicle", "Only vehicles from 2020 on",
         reason="Vehicle is older than 2020", name="Newest vehicles only"),
    Rule("R-ORION-NO-OVERNIGHT", "classify", 50, {"client_is": "orion_pharma"},
         "message_constraint", "These loads do not wait overnight",
         value="Dispatch on without an overnight hold and state the plan.",
         reason="Cold chain", name="No overnight hold"),
    Rule("R-VERTEX-GATE-6PM", "draft_message", 50, {"client_is": "vertex_retail", "dest_hub": "ludhiana"},
         "message_constraint", "The gate closes at six in the evening",
         value="Arrivals after 18:00 wait and deliver at 08:00 next morning.",
         reason="Gate closes at 18:00", name="Gate closes at six"),
    Rule("R-VERTEX-NOT-FAILED", "draft_message", 50, {"client_is": "vertex_retail"},
         "message_constraint", "A held delivery has not failed",
         value="Call a held delivery a scheduled morning delivery.",
         reason="Wording triggers a penalty", name="Never called failed"),
    Rule("R-APEX-ROTATE", "select_vehicle", 50,
         {"client_is": "apex_chemicals", "vehicle_last_client_incident": "apex_chemicals"},
         "exclude_vehicle", "Not the same truck on the very next run",
         reason="Rotate after an incident", name="Rotate after an incident", implemented=False),
    Rule("R-MONSOON-EAST-20", "classify", 10, {"month_in": [7, 8, 9], "route_east_of_lucknow": True},
         "adjust_eta_pct", "Add twenty percent going east in the rains", value="20",
         reason="Waterlogging and diversions", name="Pad estimates in the monsoon"),
    Rule("R-NEWDRIVER-NIGHT", "assign_driver", 10,
         {"driver_months_tenure": {"lt": 6}, "is_night_dispatch": True},
         "exclude_driver", "Under six months means no solo night run",
         reason="Less than six months of tenure", name="No solo nights for new drivers"),
]

RULE_SCHEMA = (
    "rule_id string, name string, step string, priority int, effect string, value string, "
    "reason string, quote string, implemented boolean"
)
CONDITION_SCHEMA = (
    "rule_id string, pos int, key string, op string, str_vals array<string>, num_vals array<double>, "
    "num double, flag boolean"
)
# A condition every context meets, standing for a rule without conditions.
ALWAYS = "__always"


def rules_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """Rules as rows."""
    rows = [(r.id, r.name, r.step, r.priority, r.effect, r.value, r.reason, r.quote, r.implemented) for r in rules]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def _conditions(rule: Rule) -> list[tuple]:
    out: list[tuple] = []
    for pos, (key, spec) in enumerate(rule.when.items()):
        if isinstance(spec, list):
            strings = [v for v in spec if isinstance(v, str)]
            numbers = [float(v) for v in spec if isinstance(v, (int, float)) and not isinstance(v, bool)]
            out.append((rule.id, pos, key, "in", strings, numbers, None, None))
        elif isinstance(spec, dict):
            out += [(rule.id, pos, key, op, None, None, float(bound), None) for op, bound in spec.items()]
        elif isinstance(spec, bool):
            out.append((rule.id, pos, key, "bool", None, None, None, spec))
        elif isinstance(spec, str):
            out.append((rule.id, pos, key, "str", [spec], None, None, None))
        else:
            out.append((rule.id, pos, key, "eq", None, None, float(spec), None))
    return out or [(rule.id, 0, ALWAYS, "always", None, None, None, None)]


def conditions_table(spark: SparkSession, rules: Sequence[Rule]) -> DataFrame:
    """Conditions as rows, one per comparison."""
    return spark.createDataFrame([c for r in rules for c in _conditions(r)], CONDITION_SCHEMA)


@dataclass
class RuleError(ValueError):
    """A rulebook that must not be used, with the reasons."""

    problems: list[str] = field(default_factory=list)

    def __str__(self) -> str:
        return "; ".join(self.problems)


def check_rules(rules: Sequence[Rule]) -> Sequence[Rule]:
    """The rules themselves, or ``RuleError`` naming everything wrong with them."""
    problems, seen = [], set()
    for r in rules:
        missing = [f for f in ("id", "step", "priority", "when", "effect", "quote") if getattr(r, f) is None]
        problems += [f"{r.id}: missing {f}" for f in missing]
        if r.id in seen:
            problems.append(f"{r.id}: duplicate id")
        seen.add(r.id)
        if r.step not in STEPS:
            problems.append(f"{r.id}: unknown step {r.step}")
        if r.effect not in EFFECTS:
            problems.append(f"{r.id}: unknown effect {r.effect}")
        for key, spec in (r.when or {}).items():
            if key not in KEY_KINDS:
                problems.append(f"{r.id}: unknown key {key}")
            if isinstance(spec, dict):
                problems += [f"{r.id}: unknown operator {op}" for op in spec if op not in OPERATORS]
    if problems:
        raise RuleError(problems)
    return rules

"""Three-valued rule evaluation: matched, not matched, or not evaluated because an input is missing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.rulebook import ALWAYS, EFFECTS, KEY_KINDS, OPERATORS, STEPS, Rule, active

_COMPARE = {
    "gt": lambda a, b: a > b,
    "gte": lambda a, b: a >= b,
    "lt": lambda a, b: a < b,
    "lte": lambda a, b: a <= b,
    "eq": lambda a, b: a == b,
    "ne": lambda a, b: a != b,
}


def match_condition(spec: Any, actual: Column, kind: str) -> Column:
    """Whether a value meets a condition; never null, and a null value meets none."""
    no = F.lit(False)
    if isinstance(spec, list):
        strings = [v for v in spec if isinstance(v, str)]
        numbers = [v for v in spec if isinstance(v, (int, float)) and not isinstance(v, bool)]
        if kind == "array":
            hit = F.arrays_overlap(actual, F.array(*[F.lit(v) for v in strings])) if strings else no
        elif kind == "num":
            hit = actual.isin(*numbers) if numbers else no
        elif kind == "str":
            hit = actual.isin(*strings) if strings else no
        else:
            flags = [v for v in spec if isinstance(v, bool)]
            hit = actual.isin(*flags) if flags else no
    elif isinstance(spec, dict):
        if kind == "array":
            return no
        number = actual.cast("int") if kind == "bool" else actual.try_cast("double")
        hit = reduce(lambda a, b: a & b, [_COMPARE[op](number, F.lit(float(v))) for op, v in spec.items()])
    elif isinstance(spec, bool):
        hit = (actual == spec) if kind == "bool" else no
    elif isinstance(spec, str):
        hit = (F.lower(actual) == spec.lower()) if kind == "str" else no
    else:
        hit = (actual == spec) if kind == "num" else no
    return F.coalesce(hit, no)


def _context(df: DataFrame, context: Mapping[str, Column] | None) -> dict[str, Column]:
    if context is not None:
        return dict(context)
    return {k: F.col(k) for k in KEY_KINDS if k in df.columns}


def rule_outcome(rule: Rule, ctx: Mapping[str, Column], kinds: Mapping[str, str] = KEY_KINDS) -> tuple[Column, Column]:
    """The names of a rule's missing keys, and whether its conditions all hold."""
    missing = [
        F.when(ctx[k].isNull(), F.lit(k)) if k in ctx else F.lit(k) for k in rule.when
    ]
    missing_keys = F.array_compact(F.array(*missing)) if missing else F.array().cast("array<string>")
    holds = F.lit(True)
    for key, spec in rule.when.items():
        holds = holds & (match_condition(spec, ctx[key], kinds[key]) if key in ctx else F.lit(False))
    return missing_keys, holds


def _texts(rule: Rule) -> list[Column]:
    parts = {
        "rule_id": rule.id, "name": rule.name, "effect": rule.effect, "value": rule.value,
        "reason": rule.reason, "quote": rule.quote,
    }
    texts = [F.lit(v).cast("string").alias(k) for k, v in parts.items()]
    return [*texts, F.lit(rule.priority).alias("priority")]


_VERDICT = """
struct(
  transform(filter({j}, r -> size(r.missing_keys) = 0 and r.holds),
    r -> struct(r.rule_id, r.name, r.effect, r.value, r.reason, r.quote, r.priority)) as matched,
  exists({j}, r -> size(r.missing_keys) = 0 and r.holds and startswith(r.effect, 'exclude_')) as excluded,
  transform(filter({j}, r -> size(r.missing_keys) = 0 and r.holds and startswith(r.effect, 'exclude_')),
    r -> struct(r.rule_id, r.reason, r.quote)) as exclusion_reasons,
  transform(filter({j}, r -> size(r.missing_keys) = 0 and r.holds),
    r -> struct(r.rule_id, r.quote)) as citations,
  transform(filter({j}, r -> size(r.missing_keys) > 0),
    r -> struct(r.rule_id, r.effect, r.missing_keys)) as unevaluated
)
"""


def evaluate_rules(
    df: DataFrame, rules: Sequence[Rule], step: str, out: str = "verdict",
    context: Mapping[str, Column] | None = None, kinds: Mapping[str, str] = KEY_KINDS,
) -> DataFrame:
    """``df`` with a verdict struct: matched, excluded, exclusion_reasons, citations, unevaluated.

    The rules are compiled into one expression per row: no join, no shuffle. Arrays are in rule order.
    """
    ctx = _context(df, context)
    judged = []
    for rule in active(rules, step):
        missing, holds = rule_outcome(rule, ctx, kinds)
        judged.append(F.struct(*_texts(rule), missing.alias("missing_keys"), holds.alias("holds")))
    return df.withColumn("__judged", F.array(*judged)).withColumn(
        out, F.expr(_VERDICT.format(j="__judged"))
    ).drop("__judged")


def first_effect(verdict: str, effect: str) -> Column:
    """The winning match of an effect that can have one value: struct(value, rule_id, quote), or null."""
    hits = F.filter(F.col(f"{verdict}.matched"), lambda m: m["effect"] == effect)
    top = F.try_element_at(hits, F.lit(1))
    return F.when(
        F.size(hits) > 0,
        F.struct(top["value"].alias("value"), top["rule_id"].alias("rule_id"), top["quote"].alias("quote")),
    )


def collect_effects(verdict: str, effect: str) -> Column:
    """All matches of an effect that accumulates: array of struct(rule_id, text, quote)."""
    return F.transform(
        F.filter(F.col(f"{verdict}.matched"), lambda m: m["effect"] == effect),
        lambda m: F.struct(
            m["rule_id"].alias("rule_id"),
            F.trim(F.regexp_replace(m["value"], r"\s+", " ")).alias("text"),
            m["quote"].alias("quote"),
        ),
    )


# --- rules as rows --------------------------------------------------------------------------------------


def active_rules(rules: DataFrame, step: str | None = None) -> DataFrame:
    """Rules in force, of one step if named; a rule that does not say counts as in force."""
    live = rules.filter(F.coalesce(F.col("implemented"), F.lit(True)))
    return live if step is None else live.filter(F.col("step") == step)


def validate_rules(
    rules: DataFrame, conditions: DataFrame, kinds: Mapping[str, str] = KEY_KINDS,
    steps: Sequence[str] = tuple(STEPS), effects: Sequence[str] = tuple(EFFECTS),
) -> DataFrame:
    """One row per (rule, problem); an empty result means the rules may be used."""
    ops = [*OPERATORS, "in", "bool", "str", "always"]
    required = ["rule_id", "step", "priority", "effect", "quote"]
    checks = [F.when(F.col(c).isNull(), F.lit(f"missing {c}")) for c in required]
    checks.append(F.when(~F.col("step").isin(*steps), F.concat(F.lit("unknown step "), F.col("step"))))
    checks.append(F.when(~F.col("effect").isin(*effects), F.concat(F.lit("unknown effect "), F.col("effect"))))
    per_rule = rules.select("rule_id", F.explode(F.array_compact(F.array(*checks))).alias("problem"))
    twice = (
        rules.filter("rule_id is not null").groupBy("rule_id").agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1").select("rule_id", F.lit("duplicate id").alias("problem"))
    )
    bad = [
        F.when(~F.col("key").isin(*kinds, ALWAYS), F.concat(F.lit("unknown key "), F.col("key"))),
        F.when(~F.col("op").isin(*ops), F.concat(F.lit("unknown operator "), F.col("op"))),
    ]
    per_condition = conditions.select("rule_id", F.explode(F.array_compact(F.array(*bad))).alias("problem"))
    return per_rule.unionByName(twice).unionByName(per_condition).distinct()


def _unpivot(df: DataFrame, ids: Sequence[str], ctx: Mapping[str, Column], kinds: Mapping[str, str]) -> DataFrame:
    def entry(key: str, kind: str, col: Column | None) -> Column:
        null = F.lit(None)
        return F.struct(
            F.lit(key).alias("key"),
            (col.cast("double") if kind in ("num", "bool") else null.cast("double")).alias("a_num"),
            (col if kind == "str" else null.cast("string")).alias("a_str"),
            (col if kind == "bool" else null.cast("boolean")).alias("a_flag"),
            (col if kind == "array" else null.cast("array<string>")).alias("a_arr"),
            (F.lit(kind)).alias("kind"),
            (col.isNull() if col is not None else F.lit(False)).alias("absent"),
        )

    types = {"num": "double", "str": "string", "bool": "boolean", "array": "array<string>"}
    entries = [entry(k, kind, ctx.get(k, F.lit(None).cast(types[kind]))) for k, kind in kinds.items()]
    entries.append(entry(ALWAYS, "always", None))
    return df.select(*ids, F.explode(F.array(*entries)).alias("e")).select(*ids, "e.*")


_MEETS = """
coalesce(case
  when op = 'always' then true
  when op = 'in' and kind = 'array' then arrays_overlap(a_arr, str_vals)
  when op = 'in' and kind = 'num' then array_contains(num_vals, a_num)
  when op = 'in' and kind = 'str' then array_contains(str_vals, a_str)
  when op = 'bool' and kind = 'bool' then a_flag = flag
  when op = 'str' and kind = 'str' then lower(a_str) = lower(str_vals[0])
  when kind not in ('num', 'str', 'bool') then false
  when op = 'gt' then coalesce(a_num, try_cast(a_str as double)) > num
  when op = 'gte' then coalesce(a_num, try_cast(a_str as double)) >= num
  when op = 'lt' then coalesce(a_num, try_cast(a_str as double)) < num
  when op = 'lte' then coalesce(a_num, try_cast(a_str as double)) <= num
  when op = 'eq' then coalesce(a_num, try_cast(a_str as double)) = num
  when op = 'ne' then coalesce(a_num, try_cast(a_str as double)) <> num
end, false)
"""


def evaluate_rules_data(
    df: DataFrame, ids: Sequence[str], rules: DataFrame, conditions: DataFrame, step: str,
    context: Mapping[str, Column] | None = None, kinds: Mapping[str, str] = KEY_KINDS,
) -> DataFrame:
    """The same outcomes with rules and conditions as tables: one row per (record, rule).

    Columns: ids, rule_id, effect, priority, missing_keys, status ('matched', 'no_match',
    'unevaluated'). For rulebooks too large to compile. The conditions join on their key and all rows
    of one record meet in the task that produced them, so the aggregate combines before its shuffle.
    """
    ctx = _context(df, context)
    live = active_rules(rules, step).select("rule_id", "effect", "priority")
    facts = _unpivot(df, ids, ctx, kinds)
    tested = facts.join(conditions.join(live, "rule_id"), "key").select(
        *ids, "rule_id", "effect", "priority", "pos", "key", "absent", F.expr(_MEETS).alias("meets")
    )
    gone = F.when(F.col("absent"), F.struct("pos", "key"))
    judged = tested.groupBy(*ids, "rule_id", "effect", "priority").agg(
        F.array_sort(F.collect_set(gone)).alias("__gone"), F.bool_and("meets").alias("__holds")
    )
    return judged.select(
        *ids, "rule_id", "effect", "priority",
        F.transform("__gone", lambda g: g["key"]).alias("missing_keys"),
        F.when(F.size("__gone") > 0, F.lit("unevaluated"))
        .when(F.col("__holds"), F.lit("matched"))
        .otherwise(F.lit("no_match")).alias("status"),
    )

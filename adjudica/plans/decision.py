"""The queue run: dedupe, validate, look up, derive as of, judge, select, assemble."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica import vocabulary as V
from adjudica.functions import temporal as T
from adjudica.functions.canonical import any_member
from adjudica.operators import asof, assemble, dedupe, select, spells, validate
from adjudica.operators.lookup import lookup_left
from adjudica.operators.rules import collect_effects, evaluate_rules, first_effect
from adjudica.rulebook import CANDIDATE_KEYS, DEFAULT_RULES, KEY_KINDS, Rule
from adjudica.session import stage

Keep = Callable[[DataFrame, str], DataFrame]
PREFERRED_CLIENT = "orion_pharma"


@dataclass(frozen=True)
class Inputs:
    """Canonical tables of one run."""

    tickets: DataFrame
    fleet: DataFrame
    history: DataFrame
    people: DataFrame


def history_predicates(notes: str = "notes") -> dict[str, Column]:
    """The three kinds of history entry the rules ask about."""
    text = F.col(notes)
    return {
        "last_service": F.lit(True),
        "last_brake": text.rlike("(?i)" + V.BRAKE_NOTE),
        "last_temp_fix": text.rlike("(?i)" + V.TEMP_FIX_NOTE) & text.rlike("(?i)" + V.PENDING_FIX_NOTE),
    }


def entry_kinds(history: DataFrame) -> dict[str, Column]:
    """The three kinds in a history, or in one that ``history_days`` has reduced to them."""
    kinds = history_predicates()
    return kinds if "notes" in history.columns else {n: F.col(n) for n in kinds}


def history_days(history: DataFrame) -> DataFrame:
    """The history as the rules ask about it: per vehicle and day, which kinds of entry it has."""
    return asof.history_days(history, "reg_canon", "date", entry_kinds(history))


def vehicle_facts(day: str = "day") -> dict[str, Column]:
    """A vehicle's facts on a day, from its row and its latest history days."""
    at = F.col(day)
    return {
        "vehicle_bs_stage": F.col("bs_stage"),
        "vehicle_year": F.col("year"),
        "vehicle_has_heater": F.col("engine_heater"),
        "vehicle_days_past_service": asof.days_past_due(F.col("last_service"), at, V.SERVICE_INTERVAL_DAYS),
        "vehicle_brake_work_days": asof.days_since_event(F.col("last_brake"), at, V.NO_SUCH_EVENT_DAYS),
        "vehicle_has_active_jugaad": asof.active_within(F.col("last_temp_fix"), at, V.TEMP_FIX_WINDOW_DAYS),
        "vehicle_last_client_incident": F.lit(None).cast("string"),
    }


def route_facts(origin: str = "origin_hub", dest: str = "dest_hub") -> dict[str, Column]:
    """The route and what it touches."""
    route = F.array_compact(F.array(origin, dest))
    return {
        "route_touches": route,
        "route_is_hill": any_member(route, V.HILL_PLACES),
        "route_east_of_lucknow": any_member(route, V.EASTERN_PLACES),
    }


def calendar_facts(ts: str = "created_at", zone: str = T.DEFAULT_ZONE) -> dict[str, Column]:
    """Day, month and night flag of an instant, read in ``zone``."""
    hour = T.local_hour(ts, zone)
    return {
        "day": T.local_date(ts, zone),
        "month_in": F.month(T.local_date(ts, zone)),
        "is_night_dispatch": T.is_night(hour),
    }


def vehicle_days(fleet: DataFrame, history: DataFrame, probes: DataFrame) -> DataFrame:
    """Facts of every probed (reg, day); ``in_pool`` tells candidates from broken vehicles."""
    latest = asof.asof_latest(probes, history, "reg_canon", "day", "date", entry_kinds(history), carry=["in_pool"])
    known = latest.join(fleet, "reg_canon")
    return known.select("reg_canon", "day", "home_hub", "in_pool", *[c.alias(n) for n, c in vehicle_facts().items()])


# Candidate facts that depend on the day: the history they look at, and the days after an entry that count as 0.
_AGED = {"vehicle_days_past_service": ("last_service", V.SERVICE_INTERVAL_DAYS), "vehicle_brake_work_days": ("last_brake", 0)}


def change_offsets(rules: Sequence[Rule]) -> dict[str, list[int]]:
    """Per kind of history entry the days after it on which a rule's view of the vehicle may change."""
    found = {name: {0} for name in history_predicates()}
    found["last_temp_fix"].add(V.TEMP_FIX_WINDOW_DAYS + 1)
    for rule in rules:
        for key, spec in rule.when.items():
            if key in _AGED:
                kind, base = _AGED[key]
                values = spec.values() if isinstance(spec, dict) else spec if isinstance(spec, list) else [spec]
                for v in values:
                    if isinstance(v, (int, float)) and not isinstance(v, bool):
                        found[kind] |= {base + math.floor(v), base + math.floor(v) + 1}
    return {kind: sorted(d for d in days if d >= 0) for kind, days in found.items()}


def pool_spells(fleet: DataFrame, history: DataFrame, exclusions: Sequence[Rule], first: date, last: date) -> DataFrame:
    """Runs of days from ``first`` to ``last`` over which the rules see a vehicle alike.

    A vehicle's facts are derived only on days when they may change: ``first``, its history days, and fixed
    numbers of days after them. Rows follow the history, not the calendar.
    """
    offsets, empty = change_offsets(exclusions), F.array().cast("array<int>")
    after = [F.when(p, F.array(*[F.lit(d) for d in offsets[kind]])).otherwise(empty) for kind, p in entry_kinds(history).items()]
    entries = history.filter(F.col("reg_canon").isNotNull() & (F.col("date") <= F.lit(last)))
    moved = entries.select("reg_canon", "date", F.explode(F.array_distinct(F.flatten(F.array(*after)))).alias("__after"))
    changes = moved.select("reg_canon", F.greatest(F.date_add("date", F.col("__after")), F.lit(first)).alias("day")).filter(F.col("day") <= F.lit(last))
    probes = changes.unionByName(fleet.select("reg_canon", F.lit(first).alias("day"))).distinct().withColumn("in_pool", F.lit(True))
    states = vehicle_days(fleet.filter("home_hub is not null"), history, probes).select(
        F.col("reg_canon").alias("cid"), "day", F.col("home_hub").alias("pool"),
        F.coalesce(F.col("vehicle_year").cast("long"), F.lit(0)).alias("vehicle_year"), candidate_signature(exclusions).alias("cand_sig"),
    )
    return spells.spells(states, "cid", "day", ["pool", "cand_sig", "vehicle_year"], last)


def pool_classes(
    fleet: DataFrame, history: DataFrame, asked: DataFrame, rules: Sequence[Rule], keep: Keep = stage,
    max_rejected: int = select.MAX_REJECTED, pool: str = "origin_hub",
) -> DataFrame:
    """The classes of each hub's vehicles on every day it had a record; see ``select.candidate_classes``."""
    days = keep(asked.select(F.col(pool).alias("pool"), "day").filter("pool is not null and day is not null").distinct(), "hub-days")
    span = days.agg(F.min("day").alias("first"), F.max("day").alias("last")).first()
    first = span["first"] or date(1970, 1, 1)
    last = span["last"] or first
    if "notes" in history.columns:
        history = keep(history_days(history), "history-days")
    runs = keep(pool_spells(fleet, history, select.exclusion_rules(rules), first, last), "spells")
    return spells.classes_on_days(runs, days, "pool", "day", "cid", ["cand_sig", "vehicle_year"], first, last, max_rejected + 1)


def pool_probes(fleet: DataFrame, tickets: DataFrame, pool: str = "origin_hub") -> DataFrame:
    """(reg, day) for every vehicle of a hub on every day that hub had a ticket, tickets deduplicated first."""
    hub_days = tickets.select(F.col(pool).alias("home_hub"), "day").filter("home_hub is not null and day is not null").distinct()
    return fleet.select("reg_canon", "home_hub").join(hub_days, "home_hub").select(
        "reg_canon", "day", F.lit(True).alias("in_pool")
    )


@dataclass(frozen=True)
class Decision:
    """The frames of one run."""

    decided: DataFrame
    duplicates: DataFrame
    invalid: DataFrame
    orphans: DataFrame


def admit(tickets: DataFrame, fleet: DataFrame, zone: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """First copies of usable records, plus unusable ones and ones naming an unknown vehicle.

    A column ``is_object`` tells items that are no records at all; they are unusable for that reason alone.
    """
    is_object = F.col("is_object") if "is_object" in tickets.columns else None
    first = validate.validate(dedupe.dedupe_first(tickets, ["ticket_id"], ["pos"]), is_object=is_object)
    usable = first.filter(F.size("reasons") == 0).withColumns(calendar_facts("created_at", zone))
    looked = lookup_left(
        usable, fleet, "vehicle_reg", "reg_canon", {"broken_vehicle_reg": "reg_canon", "broken_home_hub": "home_hub"}
    )
    return (
        looked.filter("broken_vehicle_reg is not null").drop("raw_json", "reasons"),
        first.filter(F.size("reasons") > 0),
        looked.filter("broken_vehicle_reg is null"),
    )


def build_facts(admitted: DataFrame, people: DataFrame) -> DataFrame:
    """Ticket-side facts: route, calendar, client, driver tenure."""
    with_people = lookup_left(
        admitted, people, "driver_id", "driver_id", {"known_driver": "driver_id", "joining_date": "joining_date"}
    )
    return with_people.withColumns(
        {
            "client_is": F.col("client"),
            "driver_months_tenure": T.tenure_months("joining_date", "day"),
            **route_facts(),
        }
    )


def classify(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """SLA, estimate padding, message constraints and driver blocks from two rulebook steps."""
    out = evaluate_rules(df, rules, "classify", "v_classify")
    out = evaluate_rules(out, rules, "assign_driver", "v_driver")
    out = evaluate_rules(out, rules, "draft_message", "v_draft")
    return out.withColumns(
        {
            "sla": first_effect("v_classify", "set_sla_hours"),
            "eta": first_effect("v_classify", "adjust_eta_pct"),
            "own_constraints": collect_effects("v_classify", "message_constraint"),
            "constraints": F.concat(
                collect_effects("v_classify", "message_constraint"), collect_effects("v_draft", "message_constraint")
            ),
            "driver_blocks": F.col("v_driver.exclusion_reasons"),
        }
    ).withColumns({"sla_hours": F.col("sla.value"), "eta_pad_pct": F.col("eta.value")})


def choose_source(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Which hub sends and on what basis; ``v_source`` judges the broken vehicle's own facts too."""
    out = evaluate_rules(df, rules, "select_vehicle", "v_source")
    effect = first_effect("v_source", "set_source_hub")
    return out.withColumn("sourcing", effect).withColumns(
        {
            "source_hub": F.col("origin_hub"),
            "basis": F.when(F.col("sourcing").isNull(), "undetermined")
            .when(F.col("sourcing.value") == "origin", "origin")
            .otherwise("nearest-not-implemented"),
            "confident": F.coalesce(F.col("sourcing.value") == "origin", F.lit(False)),
        }
    )


def candidate_signature(exclusions: Sequence[Rule]) -> Column:
    """A vehicle's rule letters and gap flags."""
    ctx = {k: F.col(k) for k in CANDIDATE_KEYS}
    return F.concat(select.side_signature(exclusions, ctx, candidate=True), select.gap_flags(exclusions, ctx))


def select_candidates(
    records: DataFrame, classes: DataFrame, rules: Sequence[Rule], max_rejected: int = select.MAX_REJECTED
) -> DataFrame:
    """Add the choice among the pool's vehicles to records that carry their broken vehicle's facts.

    ``classes`` come from ``pool_classes``, are small and are read twice. At most ``max_rejected`` rejected
    candidates are listed; all are counted.
    """
    exclusions = select.exclusion_rules(rules)
    n = len(exclusions)
    record_ctx = {k: F.col(k) for k in KEY_KINDS if k not in CANDIDATE_KEYS}
    signed = records.withColumns(
        {
            "rec_sig": select.side_signature(exclusions, record_ctx, candidate=False),
            "own_sig": candidate_signature(exclusions),
            "prefer": F.coalesce(F.col("client_is") == PREFERRED_CLIENT, F.lit(False)),
            "own_in_pool": F.col("broken_home_hub") == F.col("source_hub"),
            "pool": F.col("source_hub"),
        }
    )
    answers = select.profile_answers(signed, classes, n, "pool", "day", "vehicle_year", max_rejected=max_rejected)
    return select.select_top1(
        signed, answers, n, "pool", "day", "broken_vehicle_reg", "own_sig", "own_in_pool"
    )


def attach_vehicle_days(records: DataFrame, days: DataFrame) -> DataFrame:
    """Records with their own vehicle's facts on their own day."""
    own = days.filter("not in_pool").drop("home_hub", "in_pool").withColumnsRenamed({"reg_canon": "__reg", "day": "__day"})
    on = (F.col("broken_vehicle_reg") == F.col("__reg")) & (F.col("day") == F.col("__day"))
    return records.join(own, on, "left").drop("__reg", "__day")


def all_probes(fleet: DataFrame, admitted: DataFrame) -> DataFrame:
    """Every (reg, day) a run asks about: the broken vehicles and the pools. Each kind has a pair once.

    The pools need no dedupe: a vehicle has one hub, and a hub's days are distinct.
    """
    return own_probes(admitted).unionByName(pool_probes(fleet, admitted))


def own_probes(admitted: DataFrame) -> DataFrame:
    """(reg, day) of the broken vehicles."""
    pairs = admitted.select(F.col("broken_vehicle_reg").alias("reg_canon"), "day").distinct()
    return pairs.withColumn("in_pool", F.lit(False))


def decide(
    inputs: Inputs, rules: Sequence[Rule] = tuple(DEFAULT_RULES), zone: str = T.DEFAULT_ZONE, keep: Keep = stage
) -> Decision:
    """Decide every record of the queue.

    ``keep`` holds on to what several later steps read: by default it is written once to the shared
    folder, so that no step recomputes another and a lost executor costs little.
    """
    fleet = keep(inputs.fleet, "fleet")
    admitted, invalid, orphans = admit(inputs.tickets, fleet, zone)
    facts = keep(build_facts(admitted, inputs.people), "facts")
    # Reading the log costs more than all that follows from it, and three steps ask about it.
    history = keep(history_days(inputs.history), "history-days")
    days = vehicle_days(fleet, history, own_probes(facts))
    sourced = choose_source(classify(attach_vehicle_days(facts, days), rules), rules)
    classes = keep(pool_classes(fleet, history, facts, rules, keep), "classes")
    decided = select_candidates(sourced, classes, rules)
    return Decision(
        with_citations(decided, rules), dedupe.dedupe_report(inputs.tickets, ["ticket_id"], ["pos"]), invalid, orphans
    )


def with_citations(decided: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Everything a decision rests on, in order, without repeats."""
    exclusions = select.exclusion_rules(rules)
    chosen = F.filter(
        F.col("v_source.matched"), lambda m: ~F.startswith(m["effect"], F.lit("exclude_"))
    )
    parts = [
        assemble.rule_citations(F.col("v_source.citations")),
        assemble.rule_citations(F.concat(F.col("v_classify.citations"), F.col("v_driver.citations"))),
        F.when(F.col("replacement").isNotNull(), assemble.rule_citations(chosen)),
        assemble.rejected_citations(F.col("rejected"), exclusions),
        assemble.datum("tickets", "ticket_id", F.col("ticket_id")),
        assemble.datum("tickets", "km_from_origin_hub", assemble.number_text("km_from_origin")),
        F.when(
            F.col("replacement").isNotNull(), assemble.datum("fleet", "registration_number", F.col("replacement"))
        ),
    ]
    return decided.withColumn("citations", assemble.build_citations(parts))


FACT_NAMES = [
    "ticket_id", "created_at", "issue", "severity_reported", "origin_hub", "broken_vehicle_reg", "known_driver",
    "month_in", "client_is", "km_from_origin", "dest_hub", "is_night_dispatch", "driver_months_tenure",
    "vehicle_bs_stage", "vehicle_year", "vehicle_has_heater", "vehicle_days_past_service",
    "vehicle_brake_work_days", "vehicle_has_active_jugaad", "vehicle_last_client_incident",
]


def audit_lines(decided: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Audit rows of decided records, one per step that had something to say."""
    c, text = F.col, assemble.number_text
    line = assemble.audit_line
    exclusions = select.exclusion_rules(rules)
    km = F.coalesce(text("km_from_origin"), F.lit("null"))
    gaps = asof.null_gaps(FACT_NAMES)
    preferred = F.coalesce(c("client_is") == PREFERRED_CLIENT, F.lit(False))
    unevaluated = F.concat("v_classify.unevaluated", "v_driver.unevaluated")
    blocks = select.block_names(exclusions, c("fired_counts"), c("unknown_counts"), counted=True)
    names = select.block_names(exclusions, c("fired_counts"), c("unknown_counts"), counted=False)
    bool_text = lambda name: F.coalesce(c(name).cast("string"), F.lit("null"))
    lines = [
        line(
            "enrich",
            F.concat(
                F.lit("context for "), c("broken_vehicle_reg"), F.lit(": "), F.coalesce("client_is", F.lit("null")),
                F.lit(", "), km, F.lit("km from "), c("origin_hub"), F.lit(", month "), c("month_in").cast("string"),
                F.lit(", hill="), bool_text("route_is_hill"), F.lit(", night="), bool_text("is_night_dispatch"),
                F.when(F.size(gaps) > 0, F.concat(F.lit(" | undetermined: "), F.array_join(gaps, ", "))).otherwise(""),
            ),
            "vehicles, drivers, maintenance, tickets", None,
        ),
        line(
            "classify",
            F.concat(
                F.lit("severity "), F.coalesce("severity_reported", F.lit("UNSTATED")), F.lit(" (reported, not derived)"),
                F.coalesce(F.concat(F.lit(" | SLA "), c("sla_hours"), F.lit("h")), F.lit("")),
                F.coalesce(F.concat(F.lit(" | ETA padded "), c("eta_pad_pct"), F.lit("%")), F.lit("")),
                F.when(
                    F.size("own_constraints") > 0,
                    F.concat(F.lit(" | "), F.size("own_constraints").cast("string"), F.lit(" message constraint(s)")),
                ).otherwise(""),
            ),
            "tickets:severity, rules", c("sla.rule_id"),
        ),
        line(
            "classify_sla", F.concat(c("client_is"), F.lit(" planned to "), c("sla_hours"), F.lit("h")), "rules",
            c("sla.rule_id"), c("sla").isNotNull(),
        ),
        line(
            "assign_driver",
            F.concat(
                F.lit("driver "), c("known_driver"), F.lit(" ("), c("driver_months_tenure").cast("string"),
                F.lit(" months) cannot run this alone: "), c("driver_blocks")[0]["reason"],
            ),
            "drivers:joining_date, tickets:created_at", c("driver_blocks")[0]["rule_id"], F.size("driver_blocks") > 0,
        ),
        line(
            "classify_unevaluated",
            F.concat(
                F.lit("could not evaluate: "),
                F.array_join(
                    F.transform(
                        unevaluated,
                        lambda u: F.concat(u["rule_id"], F.lit(" (missing "), F.array_join(u["missing_keys"], ", "), F.lit(")")),
                    ),
                    "; ",
                ),
            ),
            "facts", None, F.size(unevaluated) > 0,
        ),
        line(
            "select_source_hub",
            F.when(
                c("basis") == "undetermined",
                F.concat(F.lit("undetermined, falling back to "), c("origin_hub"), F.lit(" for review")),
            )
            .when(c("basis") == "origin", F.concat(F.lit("origin "), c("origin_hub"), F.lit(" sends at "), km, F.lit("km")))
            .otherwise(
                F.concat(km, F.lit("km: nearest hub should send, none known, falling back to "), c("origin_hub"), F.lit(" for review"))
            ),
            "tickets:km_from_origin_hub", F.coalesce(c("sourcing.rule_id"), F.lit("ESCALATE-UNEVALUATED-SOURCING")),
        ),
        line(
            "select_vehicle",
            F.when(
                c("replacement").isNull(),
                F.concat(
                    F.lit("no eligible replacement among "), c("n_considered").cast("string"), F.lit(" candidates. "),
                    F.when(blocks == "", F.lit("none at this hub")).otherwise(F.concat(F.lit("Blocked by: "), blocks)),
                ),
            ).otherwise(
                F.concat(
                    c("replacement"), F.lit(" selected from "), c("n_considered").cast("string"), F.lit(" candidates ("),
                    c("n_eligible").cast("string"), F.lit(" eligible) - "),
                    F.when(preferred, F.concat(F.lit("newest eligible ("), c("replacement_pref").cast("string"), F.lit(")")))
                    .otherwise("first eligible"),
                )
            ),
            "vehicles, maintenance",
            F.when(c("replacement").isNull(), F.lit("NO-ELIGIBLE-VEHICLE")).when(preferred, F.lit("R-ORION-NEWEST")),
        ),
        line(
            "select_vehicle_exclusions",
            F.concat(
                (c("n_considered") - c("n_eligible")).cast("string"), F.lit(" of "), c("n_considered").cast("string"),
                F.lit(" excluded by: "), names,
            ),
            "rules, vehicles, maintenance", None, names != "",
        ),
        line("work_order", F.concat(F.lit("created "), assemble.content_id("WO", "ticket_id")), "work_orders", "IDEMPOTENT-WORK-ORDER"),
        line("comms", F.concat(F.lit("queued "), assemble.content_id("MSG", "ticket_id")), "comms", "IDEMPOTENT-COMMS"),
    ]
    numbered = decided.withColumn("__lines", F.array_compact(F.array(*lines)))
    return assemble.audit_trail(numbered, "ticket_id", "created_at", F.col("__lines"))

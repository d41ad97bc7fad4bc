"""Queries over rules, classification, selection, assembly and the outbox."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica import rulebook as R
from adjudica.functions import temporal as T
from adjudica.functions.identity import content_id
from adjudica.operators import assemble, checks, dedupe, outbox, rules, select, validate
from adjudica.plans import decision
from adjudica.plans import domain as D
from adjudica.plans import oracle as O
from adjudica.plans.registry import query
from adjudica.session import scratch_path

RUN = O.with_(*O.RUN)
UP_TO_DAYS = O.with_(*O.RUN[:6])
UP_TO_ADMITTED = O.with_(O.TICKETS, O.FLEET, O.PEOPLE, O.ADMITTED)
BOOK = R.DEFAULT_RULES


def facts(spark: SparkSession, sf: str) -> DataFrame:
    """Ticket-side facts of admitted records."""
    admitted, _, _ = decision.admit(D.tickets(spark, sf), D.fleet(spark, sf), T.DEFAULT_ZONE)
    return decision.build_facts(admitted, D.people(spark, sf))


def own_facts(spark: SparkSession, sf: str) -> DataFrame:
    """Ticket-side facts with the broken vehicle's own facts."""
    fleet = decision.stage(D.fleet(spark, sf), "fleet")
    admitted, _, _ = decision.admit(D.tickets(spark, sf), fleet, T.DEFAULT_ZONE)
    kept = decision.stage(decision.build_facts(admitted, D.people(spark, sf)), "facts")
    days = decision.vehicle_days(fleet, D.history(spark, sf), decision.own_probes(kept))
    return decision.attach_vehicle_days(kept, days)


def decided(spark: SparkSession, sf: str) -> DataFrame:
    """Every admitted record with its decision."""
    return decision.decide(D.inputs(spark, sf)).decided


def ids(c: str | Column, field: str = "rule_id", sep: str = ",") -> Column:
    """The rule ids of an array of structs as text."""
    return F.array_join(F.transform(c, lambda x: x[field]), sep)


# --- rules ---------------------------------------------------------------------------------------------

# Outcome of each select rule for a record and its own vehicle, in rule order.
_OWN = f"""
judged as (
  select t.*, v.past_service, {", ".join(f"{sql} as r{i}" for i, (_, sql, _, _) in enumerate(O.LETTERS[:5]))},
    case when t.km is null then 'M' when t.km <= 50 then 'T' else 'F' end as near,
    case when t.km is null then 'M' when t.km > 50 then 'T' else 'F' end as far,
    {O.LETTERS[5][1]} as r5
  from admitted t join vdays v on t.vehicle_reg = v.reg_canon and t.day = v.day and not v.in_pool
)"""
_SELECT_ORDER = [
    ("R-BS4-NCR-WINTER", "r0", None), ("R-HILL-BRAKE-30", "r1", None), ("R-HILL-HEATER", "r2", "vehicle_has_heater"),
    ("R-JUGAAD-7DAY", "r3", None), ("R-SERVICE-OVERDUE-30", "r4", "vehicle_days_past_service"),
    ("R-ORIGIN-50KM", "near", "km_from_origin"), ("R-ORIGIN-BEYOND-50KM", "far", "km_from_origin"),
    ("R-ORION-NEWEST", "r5", "client_is"),
]
_MATCHED = "concat_ws(',', " + ", ".join(f"case when {c} = 'T' then '{r}' end" for r, c, _ in _SELECT_ORDER) + ")"
_UNEVALUATED = "concat_ws(',', " + ", ".join(
    f"case when {c} = 'M' then '{r}:{k}' end" for r, c, k in _SELECT_ORDER if k
) + ")"


@query("evaluate_rules", O.with_(*O.RUN[:6], _OWN) + f"""
    select ticket_id, {_MATCHED} as matched, {_UNEVALUATED} as unevaluated, r0 = 'T' or r1 = 'T' or r2 = 'T' or r3 = 'T' or r4 = 'T' or r5 = 'T' as excluded from judged
""")
def evaluate_rules(spark: SparkSession, sf: str) -> DataFrame:
    judged = rules.evaluate_rules(own_facts(spark, sf), BOOK, "select_vehicle")
    unevaluated = F.transform("verdict.unevaluated", lambda u: F.concat_ws(":", u["rule_id"], F.array_join(u["missing_keys"], "+")))
    return judged.select(
        "ticket_id", ids("verdict.matched").alias("matched"), F.array_join(unevaluated, ",").alias("unevaluated"),
        F.col("verdict.excluded").alias("excluded"),
    )


@query("evaluate_rules_data", O.with_(*O.RUN[:6], _OWN) + " union all ".join(
    f"select ticket_id, '{r}' as rule_id, case {c} when 'T' then 'matched' when 'M' then 'unevaluated' else 'no_match' end as status, "
    f"case when {c} = 'M' then '{k or ''}' else '' end as missing from judged" for r, c, k in _SELECT_ORDER
))
def evaluate_rules_data(spark: SparkSession, sf: str) -> DataFrame:
    judged = rules.evaluate_rules_data(
        own_facts(spark, sf), ["ticket_id"], R.rules_table(spark, BOOK), R.conditions_table(spark, BOOK), "select_vehicle"
    )
    return judged.select("ticket_id", "rule_id", "status", F.array_join("missing_keys", "+").alias("missing"))


@query("match_condition", """
    select l_returnflag, count_if(l_quantity >= 10 and l_quantity < 30) as in_range, count_if(l_linenumber in (1, 3, 5)) as in_set,
      count_if(lower(l_linestatus) = 'o') as same_text, count_if(l_discount <> 0.05) as differs, count_if(l_linenumber > 3) as strict_true,
      cast(0 as bigint) as null_matches
    from lineitem group by l_returnflag
""")
def match_condition(spark: SparkSession, sf: str) -> DataFrame:
    li = D.table(spark, sf, "lineitem")
    match = rules.match_condition
    return li.groupBy("l_returnflag").agg(
        F.count_if(match({"gte": 10, "lt": 30}, F.col("l_quantity"), "num")).alias("in_range"),
        F.count_if(match([1, 3, 5], F.col("l_linenumber"), "num")).alias("in_set"),
        F.count_if(match("O", F.lower("l_linestatus"), "str")).alias("same_text"),
        F.count_if(match({"ne": 0.05}, F.col("l_discount"), "num")).alias("differs"),
        F.count_if(match(True, F.col("l_linenumber") > 3, "bool")).alias("strict_true"),
        F.count_if(match({"ne": 1}, F.when(F.col("l_tax") > 1, F.col("l_tax")), "num")).alias("null_matches"),
    )


def part_rules(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """A rulebook with one rule per part, some of them faulty."""
    p = D.table(spark, sf, "part")
    book = p.selectExpr(
        "case when p_partkey % 50 = 0 then 'P-shared' when p_partkey % 71 = 3 then null else concat('P-', p_partkey) end as rule_id",
        "p_name as name", "case p_type when 'ECONOMY' then 'classify' when 'SMALL' then 'assign' else 'select_vehicle' end as step",
        "p_size as priority", "case when p_size > 45 then 'explode' else 'exclude_vehicle' end as effect", "p_brand as quote",
        "case when p_partkey % 7 = 0 then false when p_partkey % 7 = 1 then true end as implemented", "p_partkey",
    )
    conditions = p.selectExpr(
        "concat('P-', p_partkey) as rule_id", "case when p_partkey % 20 = 1 then 'colour' else 'vehicle_year' end as key",
        "case when p_partkey % 30 = 2 then 'near' else 'lt' end as op",
    )
    return book, conditions


_PART_RULES = """
book as (
  select case when p_partkey % 50 = 0 then 'P-shared' when p_partkey % 71 = 3 then null else 'P-' || p_partkey end as rule_id, p_name as name,
    case p_type when 'ECONOMY' then 'classify' when 'SMALL' then 'assign' else 'select_vehicle' end as step, p_size as priority,
    case when p_size > 45 then 'explode' else 'exclude_vehicle' end as effect, p_brand as quote,
    case when p_partkey % 7 = 0 then false when p_partkey % 7 = 1 then true end as implemented, p_partkey from part
)"""


@query("validate_rules", O.with_(_PART_RULES) + """
    select rule_id, problem, count(*) as n from (select distinct * from (
      select rule_id, 'missing rule_id' as problem from book where rule_id is null
      union all select rule_id, 'unknown step assign' from book where step = 'assign'
      union all select rule_id, 'unknown effect explode' from book where effect = 'explode'
      union all select rule_id, 'duplicate id' from book where rule_id is not null group by 1 having count(*) > 1
      union all select 'P-' || p_partkey, 'unknown key colour' from part where p_partkey % 20 = 1
      union all select 'P-' || p_partkey, 'unknown operator near' from part where p_partkey % 30 = 2)) group by 1, 2
""")
def validate_rules(spark: SparkSession, sf: str) -> DataFrame:
    problems = rules.validate_rules(*part_rules(spark, sf))
    return problems.groupBy("rule_id", "problem").agg(F.count(F.lit(1)).alias("n"))


@query("active_rules", O.with_(_PART_RULES) + "select p_partkey, rule_id, priority from book where coalesce(implemented, true) and step = 'classify'")
def active_rules(spark: SparkSession, sf: str) -> DataFrame:
    book, _ = part_rules(spark, sf)
    return rules.active_rules(book, "classify").select("p_partkey", "rule_id", "priority")


# --- classification and sourcing -------------------------------------------------------------------------

_CLASSIFY = """
classified as (
  select *, case when client = 'shakti_cement' then '36' end as sla_hours,
    case when mon in (7, 8, 9) and east then '20' end as eta_pad,
    case when tenure < 6 and night then 'R-NEWDRIVER-NIGHT' else '' end as driver_blocks,
    concat_ws(',', case when client = 'orion_pharma' then 'R-ORION-NO-OVERNIGHT' end,
      case when client = 'vertex_retail' and dest_hub = 'ludhiana' then 'R-VERTEX-GATE-6PM' end,
      case when client = 'vertex_retail' then 'R-VERTEX-NOT-FAILED' end) as constraint_rules,
    concat_ws(',', case when client is null then 'R-ORION-NO-OVERNIGHT:client_is' end, case when client is null then 'R-SHAKTI-36H:client_is' end,
      case when tenure is null then 'R-NEWDRIVER-NIGHT:driver_months_tenure' end) as unevaluated
  from admitted
)"""


@query("classify", O.with_(O.TICKETS, O.FLEET, O.PEOPLE, O.ADMITTED, _CLASSIFY) + """
    select ticket_id, severity, sla_hours, eta_pad, driver_blocks, constraint_rules, unevaluated from classified
""")
def classify(spark: SparkSession, sf: str) -> DataFrame:
    out = decision.classify(facts(spark, sf), BOOK)
    gaps = F.transform(
        F.concat("v_classify.unevaluated", "v_driver.unevaluated"),
        lambda u: F.concat_ws(":", u["rule_id"], F.array_join(u["missing_keys"], "+")),
    )
    return out.select(
        "ticket_id", F.col("severity_reported").alias("severity"), "sla_hours", F.col("eta_pad_pct").alias("eta_pad"),
        ids("driver_blocks").alias("driver_blocks"), ids("constraints").alias("constraint_rules"), F.array_join(gaps, ",").alias("unevaluated"),
    )


@query("first_effect", UP_TO_ADMITTED + """
    select ticket_id, case when km <= 50 then 'origin' when km > 50 then 'nearest' end as value,
      case when km <= 50 then 'R-ORIGIN-50KM' when km > 50 then 'R-ORIGIN-BEYOND-50KM' end as rule_id from admitted
""")
def first_effect(spark: SparkSession, sf: str) -> DataFrame:
    out = rules.evaluate_rules(facts(spark, sf), BOOK, "select_vehicle")
    effect = out.select("ticket_id", rules.first_effect("verdict", "set_source_hub").alias("e"))
    return effect.select("ticket_id", "e.value", "e.rule_id")


@query("collect_effects", UP_TO_ADMITTED + """
    select ticket_id, unnest(list_filter([case when dest_hub = 'ludhiana' then 'Arrivals after 18:00 wait and deliver at 08:00 next morning.' end,
      'Call a held delivery a scheduled morning delivery.'], lambda x: x is not null)) as text from admitted where client = 'vertex_retail'
""")
def collect_effects(spark: SparkSession, sf: str) -> DataFrame:
    out = rules.evaluate_rules(facts(spark, sf), BOOK, "draft_message")
    return out.select("ticket_id", F.explode(rules.collect_effects("verdict", "message_constraint")).alias("e")).select("ticket_id", "e.text")


@query("choose_source", UP_TO_ADMITTED + """
    select ticket_id, origin_hub as source_hub, case when km is null then 'undetermined' when km <= 50 then 'origin' else 'nearest-not-implemented' end as basis,
      coalesce(km <= 50, false) as confident from admitted
""")
def choose_source(spark: SparkSession, sf: str) -> DataFrame:
    return decision.choose_source(facts(spark, sf), BOOK).select("ticket_id", "source_hub", "basis", "confident")


# --- selection ---------------------------------------------------------------------------------------------

_SIGS = """
sig as (
  select home_hub as pool, day, reg_canon as cid, year,
    case when bs_stage = 'BS4' then 'T' else 'F' end || case when brake_days < 30 then 'T' else 'F' end
    || case when heater is null then 'M' when not heater then 'T' else 'F' end || case when temp_fix then 'T' else 'F' end
    || case when past_service is null then 'M' when past_service > 30 then 'T' else 'F' end || case when year < 2020 then 'T' else 'F' end
    || '00' || case when heater is null then '1' else '0' end || '0' || case when past_service is null then '1' else '0' end || '0' as cand_sig
  from vdays where in_pool
)"""


@query("candidates_by", O.with_(*O.RUN[:6], _SIGS) + """
    select pool, strftime(day, '%Y-%m-%d') as day, cand_sig, cast(year as bigint) as year, count(*) as n,
      array_to_string(list_slice(list_sort(list(cid)), 1, 9), ',') as ids from sig group by all
""")
def candidates_by(spark: SparkSession, sf: str) -> DataFrame:
    fleet = decision.stage(D.fleet(spark, sf), "fleet")
    admitted, _, _ = decision.admit(D.tickets(spark, sf), fleet, decision.T.DEFAULT_ZONE)
    classes = decision.pool_classes(fleet, D.history(spark, sf), admitted, BOOK).withColumnRenamed("vehicle_year", "year")
    return classes.select("pool", F.col("day").cast("string").alias("day"), "cand_sig", "year", "n", F.array_join("ids", ",").alias("ids"))


_N = len(O.LETTERS)


@query("judge_candidates", RUN + "select ticket_id, rejected, " + ", ".join(f"f{i}, u{i}" for i in range(_N)) + " from selected")
def judge_candidates(spark: SparkSession, sf: str) -> DataFrame:
    rejected = F.array_join(F.transform("rejected", lambda x: F.concat_ws("=", x["cid"], x["outcome"])), ",")
    counts = [F.col(c)[i].cast("long").alias(f"{p}{i}") for i in range(_N) for p, c in (("f", "fired_counts"), ("u", "unknown_counts"))]
    return decided(spark, sf).select("ticket_id", rejected.alias("rejected"), *counts)


@query("select_top1", RUN + "select ticket_id, replacement, cast(replacement_year as bigint) as replacement_year from selected")
def select_top1(spark: SparkSession, sf: str) -> DataFrame:
    return decided(spark, sf).select("ticket_id", "replacement", F.col("replacement_pref").alias("replacement_year"))


@query("select_summary", RUN + "select ticket_id, n_considered, n_eligible from selected")
def select_summary(spark: SparkSession, sf: str) -> DataFrame:
    return decided(spark, sf).select("ticket_id", "n_considered", "n_eligible")


@query("block_summary", RUN + f"select ticket_id, {O.BLOCKS_COUNTED} as blocks, {O.BLOCKS_NAMED} as names from selected")
def block_summary(spark: SparkSession, sf: str) -> DataFrame:
    exclusions = select.exclusion_rules(BOOK)
    counts = F.col("fired_counts"), F.col("unknown_counts")
    return decided(spark, sf).select(
        "ticket_id", select.block_names(exclusions, *counts, counted=True).alias("blocks"),
        select.block_names(exclusions, *counts, counted=False).alias("names"),
    )


_HUB_ROWS = ", ".join(f"('{h}', {i})" for i, h in enumerate(O.HUBS))


@query("nearest_eligible", UP_TO_ADMITTED + f""",
    hubs as (select * from (values {_HUB_ROWS}) v(hub, i)),
    able as (
      select f.home_hub as hub, t.ticket_id from fleet f, (select ticket_id, client from admitted) t
      where t.client is not null and f.heater is not null and not (t.client = 'orion_pharma' and f.year < 2020) group by all)
    select t.ticket_id, n.hub as nearest_pool from admitted t join (
      select a.ticket_id, arg_min(o.hub, (abs(h.i - o.i), o.hub)) as hub
      from admitted a join hubs h on a.origin_hub = h.hub join able b on a.ticket_id = b.ticket_id join hubs o on b.hub = o.hub group by 1
    ) n using (ticket_id)
""")
def nearest_eligible(spark: SparkSession, sf: str) -> DataFrame:
    # Only rules that do not depend on the day take part, so pools need no day; records share few profiles.
    exclusions = [r for r in select.exclusion_rules(BOOK) if r.id in ("R-HILL-HEATER", "R-ORION-NEWEST")]
    records = facts(spark, sf).withColumns(
        {
            "rec_sig": select.side_signature(exclusions, {k: F.col(k) for k in R.KEY_KINDS if k not in R.CANDIDATE_KEYS}, False),
            "prefer": F.lit(False),
            "mon_free": F.lit("any"),
        }
    ).withColumn("rec_sig", F.concat(F.lit("F"), F.substring("rec_sig", 2, 1)))
    vehicles = D.fleet(spark, sf).select(
        F.col("home_hub").alias("pool"), F.lit("any").alias("mon_free"), F.col("reg_canon").alias("cid"), F.col("year").alias("vehicle_year"),
        F.col("engine_heater").alias("vehicle_has_heater"),
    )
    ctx = {"vehicle_has_heater": F.col("vehicle_has_heater"), "vehicle_year": F.col("vehicle_year")}
    signed = vehicles.withColumn(
        "cand_sig", F.concat(select.side_signature(exclusions, ctx, True), select.gap_flags(exclusions, ctx))
    )
    classes = select.candidate_classes(signed, "pool", "mon_free", "cid", "vehicle_year")
    pools = classes.select("pool", "mon_free").distinct()
    profiles = records.select("mon_free", "rec_sig", "prefer").distinct().join(pools, "mon_free")
    answers = select.profile_answers(profiles, classes, 2, "pool", "mon_free", "vehicle_year")
    place = F.array(*[F.lit(h) for h in O.HUBS])
    from_pool, to_pool = F.col("from_pool"), F.col("to_pool")
    # Every hub records come from, also one without vehicles of its own.
    origins = records.select(F.col("origin_hub").alias("from_pool")).distinct()
    distances = origins.select("from_pool", F.explode(place).alias("to_pool")).withColumn(
        "km", F.abs(F.array_position(place, from_pool) - F.array_position(place, to_pool))
    )
    found = select.nearest_eligible(records, answers, distances, "origin_hub", "mon_free", "rec_sig")
    return found.filter("nearest_pool is not null").select("ticket_id", "nearest_pool")


# --- assembly -----------------------------------------------------------------------------------------------

_QUOTE = {r.id: r.quote for r in BOOK}


def _rule_cite(rule: str, when: str) -> str:
    return f"case when {when} then 'rules#{rule}~{_QUOTE[rule]}' end"


# First five refused candidates, fired rules before gaps, as the citation texts of one candidate.
_CITES = f"""
cited_pairs as (
  select ticket_id, cid, list_filter([
    {", ".join(f"case when r{i} = 'T' then 'rules#{rid}~{quote}~' || cid end" for i, (rid, _, quote, _) in enumerate(O.LETTERS))},
    {", ".join(f"case when r{i} = 'M' then 'rules#{rid}~' || cid || '~' || {gap} end" for i, (rid, _, _, gap) in enumerate(O.LETTERS) if gap)}
  ], lambda x: x is not null) as texts
  from pairs where blocked qualify row_number() over (partition by ticket_id order by cid) <= 5
),
cited_refused as (select ticket_id, flatten(list(texts order by cid)) as texts from cited_pairs group by 1),
own as (
  select s.ticket_id, list_filter([{", ".join(_rule_cite(r, f"j.{c} = 'T'") for r, c, _ in _SELECT_ORDER)}], lambda x: x is not null) as source_texts,
    list_filter([{", ".join(_rule_cite(r, f"j.{c} = 'T'") for r, c, _ in _SELECT_ORDER if c in ("near", "far"))}], lambda x: x is not null) as sourcing_texts
  from selected s join judged j using (ticket_id)
),
all_cites as (
  select s.ticket_id, list_concat(o.source_texts,
    list_filter([{_rule_cite("R-ORION-NO-OVERNIGHT", "s.client = 'orion_pharma'")}, {_rule_cite("R-SHAKTI-36H", "s.client = 'shakti_cement'")},
      {_rule_cite("R-MONSOON-EAST-20", "s.mon in (7, 8, 9) and s.east")}, {_rule_cite("R-NEWDRIVER-NIGHT", "s.tenure < 6 and s.night")}], lambda x: x is not null),
    coalesce(r.texts, []), ['tickets~ticket_id~' || s.ticket_id, 'tickets~km_from_origin_hub' || coalesce('~' || {O.NUM.format("s.km")}, '')],
    case when s.replacement is not null then ['fleet~registration_number~' || s.replacement] else [] end) as texts
  from selected s join own o using (ticket_id) left join cited_refused r using (ticket_id)
)"""
CITED = O.with_(*O.RUN, _OWN, _CITES)


def citation_text(citations: str = "citations") -> Column:
    """Citations as one text."""
    return F.array_join(
        F.transform(
            citations,
            lambda c: F.concat_ws("~", c["source"], c["quote"], c["field"], c["value"], c["excluded"], F.array_join(c["undetermined"], "+")),
        ),
        "|",
    )


@query("build_citations", CITED + "select ticket_id, array_to_string(texts, '|') as citations from all_cites")
def build_citations(spark: SparkSession, sf: str) -> DataFrame:
    return decided(spark, sf).select("ticket_id", citation_text().alias("citations"))


@query("rule_usage", CITED + """
    select rule_id, count(*) as n_cited from (select split_part(substr(unnest(texts), 7), '~', 1) as rule_id, unnest(texts) as t from all_cites)
    where starts_with(t, 'rules#') group by 1
""")
def rule_usage(spark: SparkSession, sf: str) -> DataFrame:
    return checks.rule_usage(decided(spark, sf))


@query("rules_cited", CITED + """
    select ticket_id, string_agg(rule_id, ',' order by pos) as rules_cited from (
      select ticket_id, rule_id, min(i) as pos from (
        select ticket_id, unnest(range(len(texts))) as i, split_part(substr(unnest(texts), 7), '~', 1) as rule_id, unnest(texts) as t from all_cites)
      where starts_with(t, 'rules#') group by 1, 2) group by 1
""")
def rules_cited(spark: SparkSession, sf: str) -> DataFrame:
    out = decided(spark, sf).select("ticket_id", F.array_join(checks.rules_cited(), ",").alias("rules_cited"))
    return out.filter("rules_cited <> ''")


@query("build_orders", RUN + """
    select 'WO-' || substr(sha256(ticket_id), 1, 32) as work_order_id, ticket_id, vehicle_reg, replacement as replacement_reg, origin_hub, severity,
      strftime(ats - interval 330 minute, '%Y-%m-%dT%H:%M:%S') || '.000Z' as created_at from selected
""")
def build_orders(spark: SparkSession, sf: str) -> DataFrame:
    orders = assemble.build_orders(decided(spark, sf))
    return orders.drop("citations").withColumn("created_at", T.utc_text("created_at"))


_BODY = """
concat_ws(' ', 'The vehicle with your goods is off the road, see our file ' || s.ticket_id || '.',
  'Noted at the roadside: ' || s.issue || ', urgency ' || coalesce(s.severity, 'not set so far') || '.',
  case when s.replacement is not null then s.replacement || ' leaves ' || s.origin_hub || ' to take the load over.'
    else 'No substitute is fixed so far; its number and arrival follow.' end,
  case when s.client = 'shakti_cement' then 'Delivery stays planned within 36 hours.' end,
  case when s.mon in (7, 8, 9) and s.east then 'Rain season: 20% more time is part of every arrival we state.' end,
  case when s.client = 'orion_pharma' then 'Please note: Dispatch on without an overnight hold and state the plan.' end,
  case when s.client = 'vertex_retail' and s.dest_hub = 'ludhiana' then 'Please note: Arrivals after 18:00 wait and deliver at 08:00 next morning.' end,
  case when s.client = 'vertex_retail' then 'Please note: Call a held delivery a scheduled morning delivery.' end)
"""


@query("draft_messages", RUN + f"""
    select 'MSG-' || substr(sha256(ticket_id), 1, 32) as message_id, ticket_id, client as recipient, {_BODY} as body, 'pending' as status,
      origin_hub || ' -> ' || coalesce(dest_hub, 'null') as route, n_considered, n_eligible from selected s
""")
def draft_messages(spark: SparkSession, sf: str) -> DataFrame:
    messages = assemble.draft_messages(decided(spark, sf), select.exclusion_rules(BOOK))
    return messages.select(
        "message_id", "ticket_id", "recipient", "body", "status", F.col("context.route").alias("route"),
        F.col("context.candidates_considered").alias("n_considered"), F.col("context.candidates_eligible").alias("n_eligible"),
    )


@query("approval_queue", CITED + """
    select ticket_id, s.client as recipient, s.origin_hub || ' -> ' || coalesce(s.dest_hub, 'null') as route, s.n_considered, s.n_eligible,
      s.rejected = '' as none_rejected, case when s.tenure < 6 and s.night then 1 else 0 end as n_driver_constraints,
      len(list_distinct(list_transform(list_filter(c.texts, lambda t: starts_with(t, 'rules#')), lambda t: split_part(t, '~', 1)))) as n_rules
    from selected s join all_cites c using (ticket_id)
""")
def approval_queue(spark: SparkSession, sf: str) -> DataFrame:
    queue = outbox.approval_queue(assemble.draft_messages(decided(spark, sf), select.exclusion_rules(BOOK)))
    return queue.select(
        "ticket_id", "recipient", "route", F.col("candidates_considered").alias("n_considered"),
        F.col("candidates_eligible").alias("n_eligible"), (F.size("rejected") == 0).alias("none_rejected"),
        F.size("driver_constraints").alias("n_driver_constraints"), F.size("rules_cited").cast("long").alias("n_rules"),
    )


@query("audit_trail", O.with_(*O.RUN, _CLASSIFY) + f"""
    select ticket_id, step, decision from (
      select s.*, c.sla_hours, c.eta_pad, c.unevaluated as gaps from selected s join classified c using (ticket_id)) s,
    lateral (select unnest(['select_source_hub', 'select_vehicle', 'select_vehicle_exclusions', 'classify', 'classify_sla', 'classify_unevaluated', 'assign_driver', 'work_order', 'comms']) as step,
      unnest([
        case when km is null then 'undetermined, falling back to ' || origin_hub || ' for review'
          when km <= 50 then 'origin ' || origin_hub || ' sends at ' || {O.NUM.format("km")} || 'km'
          else {O.NUM.format("km")} || 'km: nearest hub should send, none known, falling back to ' || origin_hub || ' for review' end,
        case when replacement is null then 'no eligible replacement among ' || n_considered || ' candidates. ' ||
            case when {O.BLOCKS_COUNTED} = '' then 'none at this hub' else 'Blocked by: ' || {O.BLOCKS_COUNTED} end
          else replacement || ' selected from ' || n_considered || ' candidates (' || n_eligible || ' eligible) - ' ||
            case when coalesce(client = 'orion_pharma', false) then 'newest eligible (' || replacement_year || ')' else 'first eligible' end end,
        case when {O.BLOCKS_NAMED} <> '' then (n_considered - n_eligible) || ' of ' || n_considered || ' excluded by: ' || {O.BLOCKS_NAMED} end,
        'severity ' || coalesce(severity, 'UNSTATED') || ' (reported, not derived)' || coalesce(' | SLA ' || sla_hours || 'h', '') ||
          coalesce(' | ETA padded ' || eta_pad || '%', '') || case when client = 'orion_pharma' then ' | 1 message constraint(s)' else '' end,
        case when sla_hours is not null then client || ' planned to ' || sla_hours || 'h' end,
        case when gaps <> '' then 'could not evaluate: ' || replace(regexp_replace(gaps, ':([a-z_]+)', ' (missing \\1)', 'g'), ',', '; ') end,
        case when tenure < 6 and night then 'driver ' || known_driver || ' (' || tenure || ' months) cannot run this alone: Less than six months of tenure' end,
        'created WO-' || substr(sha256(ticket_id), 1, 32), 'queued MSG-' || substr(sha256(ticket_id), 1, 32)]) as decision)
    where decision is not null
""")
def audit_trail(spark: SparkSession, sf: str) -> DataFrame:
    lines = decision.audit_lines(decided(spark, sf), BOOK)
    return lines.filter("step <> 'enrich'").select("ticket_id", "step", "decision")


@query("audited_keys", UP_TO_ADMITTED + "select ticket_id from admitted")
def audited_keys(spark: SparkSession, sf: str) -> DataFrame:
    classified = decision.classify(facts(spark, sf), BOOK)
    lines = F.array(assemble.audit_line("classify", F.coalesce("severity_reported", F.lit("UNSTATED")), "tickets", None))
    trail = assemble.audit_trail(classified, "ticket_id", "created_at", lines)
    return checks.audited_keys(trail.unionByName(trail))


@query("check_audited", UP_TO_ADMITTED + "select ticket_id from admitted where client <> 'shakti_cement' or client is null")
def check_audited(spark: SparkSession, sf: str) -> DataFrame:
    classified = decision.classify(facts(spark, sf), BOOK)
    lines = F.array_compact(
        F.array(assemble.audit_line("classify_sla", F.col("sla_hours"), "rules", F.col("sla.rule_id"), F.col("sla").isNotNull()))
    )
    trail = assemble.audit_trail(classified, "ticket_id", "created_at", lines)
    return checks.check_audited(classified, trail)


# --- outbox -------------------------------------------------------------------------------------------------

_EARLIER = "timestamp '2018-01-01 00:00:00'"


@query("insert_absent", UP_TO_ADMITTED + f"""
    select coalesce(t.ticket_id, '') as ticket_id, t.pos, t.ticket_id is null or s.ticket_id is null as created
    from first_t t left join (select distinct ticket_id from tickets where ats < {_EARLIER} and ticket_id is not null) s using (ticket_id)
""")
def insert_absent(spark: SparkSession, sf: str) -> DataFrame:
    t = D.tickets(spark, sf).select("ticket_id", "pos", "created_at")
    state = t.filter(T.wall_clock("created_at") < F.lit("2018-01-01 00:00:00").cast("timestamp_ntz")).filter("ticket_id is not null")
    out = outbox.insert_absent(t, state, ["ticket_id"], ["pos"])
    return out.select(F.coalesce("ticket_id", F.lit("")).alias("ticket_id"), "pos", "created")


_APPROVALS = """
approvals as (
  select 'TKT-' || (event_id * 3 // 2 - event_id % 2) as ticket_id, case when event_type = 'error' then null else 'user' || user_id end as approver, ts as at_ts, event_id from events
),
msgs as (select distinct ticket_id from tickets where ticket_id is not null),
firsts as (select ticket_id, min((at_ts, approver)) as a from approvals where approver is not null group by 1)"""


def _approvals(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    messages = D.tickets(spark, sf).filter("ticket_id is not null").select("ticket_id").distinct().select(
        "ticket_id", F.lit("pending").alias("status"), F.lit(None).cast("string").alias("approved_by"),
        F.lit(None).cast("timestamp_ntz").alias("sent_at"),
    )
    approvals = D.table(spark, sf, "events").selectExpr(
        "concat('TKT-', event_id * 3 div 2 - event_id % 2) as ticket_id",
        "case when event_type = 'error' then ' ' else concat('user', user_id) end as approver", "ts as at", "event_id",
    )
    return outbox.apply_approvals(messages, approvals)


@query("apply_approvals", O.with_(O.TICKETS, _APPROVALS) + """
    select ticket_id, case when a is null then 'pending' else 'sent' end as status, a[2] as approved_by,
      strftime(a[1], '%Y-%m-%d %H:%M:%S') as sent_at from msgs left join firsts using (ticket_id)
""")
def apply_approvals(spark: SparkSession, sf: str) -> DataFrame:
    sent, _ = _approvals(spark, sf)
    return sent.select("ticket_id", "status", "approved_by", F.date_format("sent_at", "yyyy-MM-dd HH:mm:ss").alias("sent_at"))


@query("approval_outcomes", O.with_(O.TICKETS, _APPROVALS) + """
    select event_id, case when approver is null then 'approver_required' when m.ticket_id is null then 'unknown_ticket'
      when f.a = (at_ts, approver) then 'sent' else 'already_sent' end as outcome
    from approvals p left join msgs m using (ticket_id) left join firsts f using (ticket_id)
""")
def approval_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    _, outcome = _approvals(spark, sf)
    return outcome.select("event_id", "outcome")


@query("run_summary", UP_TO_ADMITTED + """
    select 'processed' as outcome, count(*) as n from admitted
    union all select 'duplicates', count(*) from tickets where copy = 1 and ticket_id is not null
    union all select 'quarantined', (select count(*) from first_t) - (select count(*) from admitted)
""")
def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    t = D.tickets(spark, sf)
    admitted, invalid, orphans = decision.admit(t, D.fleet(spark, sf), T.DEFAULT_ZONE)
    quarantined = invalid.select("pos").unionByName(orphans.select("pos"))
    return outbox.run_summary(
        {"processed": admitted, "duplicates": dedupe.dedupe_report(t, ["ticket_id"], ["pos"]), "quarantined": quarantined}
    )


@query("publish_batch", UP_TO_ADMITTED + """
    select 'orders' as kind, 'WO-' || substr(sha256(ticket_id), 1, 32) as id, ticket_id from usable
    union all select 'messages', 'MSG-' || substr(sha256(ticket_id), 1, 32), ticket_id from usable
""")
def publish_batch(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "outbox")
    first = validate.validate(dedupe.dedupe_first(D.tickets(spark, sf), ["ticket_id"], ["pos"])).filter(F.size("reasons") == 0)
    usable = decision.stage(first.select("ticket_id", "created_at"), "usable")
    cutoff = F.lit("2018-01-01 00:00:00").cast("timestamp_ntz")
    # An early batch, then the whole queue, then the whole queue again: only what is new is added.
    batches = [("b1", usable.filter(T.wall_clock("created_at") < cutoff)), ("b2", usable), ("b3", usable)]
    schema = "id string, ticket_id string"
    for label, batch in batches:
        frames = {}
        for name, prefix in (("orders", "WO"), ("messages", "MSG")):
            made = batch.select(content_id(prefix, "ticket_id").alias("id"), "ticket_id")
            frames[name] = outbox.new_rows(made, outbox.state_for(made, root, name, schema, ["ticket_id"], label), ["ticket_id"], ["id"])
        outbox.publish_batch(frames, root, label, dict.fromkeys(frames, ["ticket_id"]))
    kinds = [outbox.read_state(spark, root, n, schema).select(F.lit(n).alias("kind"), "id", "ticket_id") for n in ("orders", "messages")]
    return kinds[0].unionByName(kinds[1])

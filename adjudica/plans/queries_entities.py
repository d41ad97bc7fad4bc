"""Queries over entities: merging, conflicts, dedupe, validation, lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.functions import temporal as T
from adjudica.functions.identity import content_fingerprint
from adjudica.operators import asof, checks, dedupe, lookup, resolve, validate
from adjudica.plans import decision
from adjudica.plans import domain as D
from adjudica.plans import oracle as O
from adjudica.plans.registry import query

TK = O.with_(O.TICKETS)
FL = O.with_(O.FLEET)


@query("resolve_entities", FL + """
    select reg_canon, vehicle_id, model, year, bs_stage, heater as engine_heater, home_hub, capacity as capacity_tonnes,
      s * 3 + 3 as source_row, n_rows from fleet
""")
def resolve_entities(spark: SparkSession, sf: str) -> DataFrame:
    return D.fleet(spark, sf).select("reg_canon", *D.MERGE_FIELDS, "source_row", "n_rows")


@query("entity_spellings", FL + """
    select reg_canon, reg_canon as spelling, 1 as n_rows from fleet
    union all select reg_canon, lower(reg_canon), 1 from fleet where s % 15 = 0
    union all select reg_canon, substr(reg_canon, 1, 2) || ' ' || substr(reg_canon, 3, 4) || '-' || substr(reg_canon, 7), 1 from fleet where s % 5 = 0
""")
def entity_spellings(spark: SparkSession, sf: str) -> DataFrame:
    return resolve.entity_spellings(D.fleet_rows(D.raw_fleet(spark, sf)), "reg_canon", "raw_reg")


@query("field_conflicts", O.with_(O.FLEET, O.CONFLICTS) + "select * from conflicts")
def field_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return fleet_conflicts(spark, sf).select("reg_canon", "field", "winner", "winner_row", "loser", "loser_row")


def fleet_conflicts(spark: SparkSession, sf: str, keep: str = "last") -> DataFrame:
    """Where the fleet register disagrees with itself."""
    rows = D.fleet_rows(D.raw_fleet(spark, sf))
    merged = resolve.resolve_entities(rows, "reg_canon", "vehicle_id", "source_row", D.MERGE_FIELDS)
    return resolve.field_conflicts(rows, merged, "reg_canon", "source_row", D.MERGE_FIELDS, keep=keep)


@query("field_conflicts_all", O.with_(O.FLEET, O.CONFLICTS) + """
    select * from conflicts
    union all select reg_canon, 'year', cast(year as varchar), s * 3 + 3, cast(year + 2 as varchar), s * 3 + 2
    from fleet where s % 30 = 0
""")
def field_conflicts_all(spark: SparkSession, sf: str) -> DataFrame:
    return fleet_conflicts(spark, sf, "all").select("reg_canon", "field", "winner", "winner_row", "loser", "loser_row")


@query("cross_source_conflicts", """
    with claims as (
      select sha256(text) as entity, 'lang' as field, lang as value, source, cast(substr(source, 4) as integer) as rank from documents
      union all select sha256(text), 'source', source, source, cast(substr(source, 4) as integer) from documents),
    v as (select entity, field, value, min((rank, source, value)) as c from claims group by all),
    w as (select entity, field, min(c) as w from v group by all)
    select entity, field, w[3] as winner, w[2] as winner_source, value as loser, c[2] as loser_source
    from v join w using (entity, field) where value <> w[3]
""")
def cross_source_conflicts(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.table(spark, sf, "documents").select(
        F.sha2("text", 256).alias("entity"), "lang", "source", F.expr("cast(substr(source, 4) as int)").alias("source_rank")
    )
    claims = docs.select(
        "entity", "source", "source_rank",
        F.explode(F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"))).alias("field", "value"),
    )
    return resolve.cross_source_conflicts(claims)


@query("dedupe_first", O.with_(O.TICKETS, O.FLEET, O.PEOPLE, O.ADMITTED) + "select pos, ticket_id, strftime(ats, '%Y-%m-%d %H:%M') as at from first_t")
def dedupe_first(spark: SparkSession, sf: str) -> DataFrame:
    t = D.tickets(spark, sf).select("pos", "ticket_id", "created_at")
    return dedupe.dedupe_first(t, ["ticket_id"], ["pos"]).select(
        "pos", "ticket_id", F.date_format(T.wall_clock("created_at"), "yyyy-MM-dd HH:mm").alias("at")
    )


@query("dedupe_report", TK + "select ticket_id, pos, k * 2 as kept_pos from tickets where copy = 1 and ticket_id is not null")
def dedupe_report(spark: SparkSession, sf: str) -> DataFrame:
    t = D.tickets(spark, sf).select("pos", "ticket_id")
    return dedupe.dedupe_report(t, ["ticket_id"], ["pos"]).select("ticket_id", "pos", F.col("kept.pos").alias("kept_pos"))


@query("dedupe_copies", """
    select sha256(text) as content, count(*) - 1 as n_dropped, min(doc_id) as kept from documents group by 1 having count(*) > 1
""")
def dedupe_copies(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.table(spark, sf, "documents").select("doc_id", F.sha2("text", 256).alias("content"))
    dropped = dedupe.dedupe_report(docs, ["content"], ["doc_id"])
    return dropped.groupBy("content").agg(F.count(F.lit(1)).alias("n_dropped"), F.min("kept.doc_id").alias("kept"))


_HISTORY_KEYS = "reg_canon, strftime(day, '%Y-%m-%d') as day, odometer, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"


@query("insert_ignore", O.with_(O.HISTORY) + f"""
    select {_HISTORY_KEYS} from history where odometer is null
    union all select {_HISTORY_KEYS} from (
      select * from history where odometer is not null
      qualify row_number() over (partition by reg_canon, history.day, odometer order by l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) = 1)
""")
def insert_ignore(spark: SparkSession, sf: str) -> DataFrame:
    h = D.history(spark, sf).drop("mechanic", "notes")
    kept = dedupe.insert_ignore(h, ["reg_canon", "date", "odometer_km"], D.HISTORY_ORDER)
    return kept.select(
        "reg_canon", F.col("date").cast("string").alias("day"), F.col("odometer_km").alias("odometer"), *D.HISTORY_ORDER
    )


@query("load_events_history", O.with_(O.HISTORY) + "select reg_canon, count(*) as n_rows, count(distinct day) as n_days, count(odometer) as n_odometer, count_if(is_brake) as n_brake, cast(sum(length(notes)) as bigint) as note_chars from history group by 1")
def load_events_history(spark: SparkSession, sf: str) -> DataFrame:
    h = D.history(spark, sf)
    brake = F.col("notes").rlike("(?i)brake")
    return h.groupBy("reg_canon").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("date").alias("n_days"), F.count("odometer_km").alias("n_odometer"),
        F.count_if(brake).alias("n_brake"), F.sum(F.length("notes")).alias("note_chars"),
    )


@query("upsert_last", """
    select user_id, event_type, event_id, value from events
    qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1
""")
def upsert_last(spark: SparkSession, sf: str) -> DataFrame:
    e = D.table(spark, sf, "events").select("user_id", "event_type", "event_id", "value", "ts")
    before = e.filter("ts < timestamp_ntz'2024-01-15 00:00:00'")
    stored = dedupe.upsert_last(before, ["user_id", "event_type"], ["ts", "event_id"])
    batch = e.filter("ts >= timestamp_ntz'2024-01-15 00:00:00'")
    return dedupe.upsert_last(batch, ["user_id", "event_type"], ["ts", "event_id"], stored).select(
        "user_id", "event_type", "event_id", "value"
    )


@query("load_people", O.with_(O.PEOPLE) + "select driver_id, name, phone_masked, dl_masked, aadhaar_masked, strftime(joined, '%Y-%m-%d') as joining_date, home_hub, source_row from people")
def load_people(spark: SparkSession, sf: str) -> DataFrame:
    return D.people(spark, sf).withColumn("joining_date", F.col("joining_date").cast("string"))


@query("load_trips", """
    select 'T' || event_id as trip_id, strftime(ts, '%Y-%m-%d %H:%M') as at, 'DRV-' || lpad(cast(user_id as varchar), cast(greatest(3, length(cast(user_id as varchar))) as integer), '0') as driver_id,
      upper(event_type) as status, value as actual_time_min from events
""")
def load_trips(spark: SparkSession, sf: str) -> DataFrame:
    from adjudica.functions import canonical as C

    raw = D.table(spark, sf, "events").selectExpr(
        "concat('T', event_id) as trip_id", "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") as created_at", "concat('drv', user_id) as driver_id",
        "concat(' ', event_type) as status", "concat(value, ' min') as actual_time_min", "explode(array(0, 1)) as copy",
    )
    typed = raw.select(
        "trip_id", T.parse_ts("created_at").alias("created_at"), C.norm_prefixed_id("driver_id").alias("driver_id"),
        F.upper(F.trim("status")).alias("status"), C.norm_num("actual_time_min").alias("actual_time_min"), "copy",
    ).filter("trip_id is not null")
    first = dedupe.insert_ignore(typed, ["trip_id"], ["copy"])
    return first.select(
        "trip_id", F.date_format(T.wall_clock("created_at"), "yyyy-MM-dd HH:mm").alias("at"), "driver_id", "status", "actual_time_min"
    )


@query("validate", TK + """
    select pos, concat_ws(',', case when ticket_id is null then 'missing_ticket_id' end, case when vehicle_reg is null then 'missing_vehicle' end,
      case when origin_hub is null then 'missing_origin_hub' end, case when ats is null then 'unparseable_created_at' end) as reasons
    from tickets
""")
def validate_records(spark: SparkSession, sf: str) -> DataFrame:
    return validate.validate(D.tickets(spark, sf)).select("pos", F.array_join("reasons", ",").alias("reasons"))


@query("quarantine_rows", O.with_(O.TICKETS, O.FLEET, O.PEOPLE, O.ADMITTED) + """
    select pos, coalesce(ticket_id, 'MALFORMED') as ticket_key, unnest(list_filter([case when ticket_id is null then 'missing_ticket_id' end,
      case when vehicle_reg is null then 'missing_vehicle' end, case when origin_hub is null then 'missing_origin_hub' end,
      case when ats is null then 'unparseable_created_at' end], lambda x: x is not null)) as reason from first_t
""")
def quarantine_rows(spark: SparkSession, sf: str) -> DataFrame:
    first = validate.validate(dedupe.dedupe_first(D.tickets(spark, sf), ["ticket_id"], ["pos"]))
    rows = validate.quarantine_rows(first, "ticket_id", "raw_json", D.SALT, ["pos"])
    return rows.select("pos", F.regexp_replace("ticket_key", "^(MALFORMED):Q-[0-9a-f]{32}$", "$1").alias("ticket_key"), "reason")


@query("reject_orphans", O.with_(O.TICKETS, O.FLEET) + "select pos, vehicle_reg from tickets where vehicle_reg is not null and vehicle_reg not in (select reg_canon from fleet)")
def reject_orphans(spark: SparkSession, sf: str) -> DataFrame:
    t = D.tickets(spark, sf).select("pos", "vehicle_reg")
    return validate.reject_orphans(t, D.fleet(spark, sf), "vehicle_reg", "reg_canon").select("pos", "vehicle_reg")


@query("lookup_left", O.with_(O.TICKETS, O.FLEET) + """
    select pos, t.vehicle_reg, f.home_hub, f.year, f.reg_canon is not null as found from tickets t left join fleet f on t.vehicle_reg = f.reg_canon
""")
def lookup_left(spark: SparkSession, sf: str) -> DataFrame:
    t = D.tickets(spark, sf).select("pos", "vehicle_reg")
    return lookup.lookup_left(t, D.fleet(spark, sf), "vehicle_reg", "reg_canon", {"home_hub": "home_hub", "year": "year"}, "found")


@query("topk_per_key", """
    select l_suppkey, l_orderkey, l_linenumber, l_partkey, rank from (
      select *, row_number() over (partition by l_suppkey order by l_shipdate desc, l_orderkey, l_linenumber, l_partkey, l_extendedprice) as rank from lineitem) where rank <= 20
""")
def topk_per_key(spark: SparkSession, sf: str) -> DataFrame:
    li = D.table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice")
    order = [F.col("l_shipdate").desc(), *[F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")]]
    top = lookup.topk_per_key(li, ["l_suppkey"], order, 20)
    return top.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", F.col("rank").cast("long").alias("rank"))


@query("ordered_export", "select c_custkey, c_name, c_mktsegment from customer order by c_mktsegment, c_custkey")
def ordered_export(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.ordered_export(D.table(spark, sf, "customer"), ["c_mktsegment", "c_custkey"], ["c_custkey", "c_name", "c_mktsegment"])


@query("exists_semi", "select c_custkey, c_name from customer where c_custkey in (select o_custkey from orders)")
def exists_semi(spark: SparkSession, sf: str) -> DataFrame:
    buyers = D.table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"))
    return lookup.exists_semi(D.table(spark, sf, "customer"), buyers, ["c_custkey"]).select("c_custkey", "c_name")


@query("table_counts", " union all ".join(f"select '{t}' as table_name, count(*) as n_rows from {t}" for t in D.TABLES))
def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.table_counts({t: D.table(spark, sf, t) for t in D.TABLES})


@query("search_contains", "select doc_id, lang from documents where contains(lower(text), 'ing') order by doc_id limit 40")
def search_contains(spark: SparkSession, sf: str) -> DataFrame:
    return lookup.search_contains(D.table(spark, sf, "documents"), "text", "ing", "doc_id").select("doc_id", "lang")


# --- as of ---------------------------------------------------------------------------------------------

_PROBES = "probes as (select distinct l_suppkey as k, cast(o_orderdate as date) as at from orders join lineitem on o_orderkey = l_orderkey)"
_ASOF = f"""
    with {_PROBES},
    a as (select l_suppkey as k, cast(l_shipdate as date) as d from lineitem group by all),
    r as (select l_suppkey as k, cast(l_shipdate as date) as d from lineitem where l_returnflag = 'R' group by all)
    select p.k, strftime(p.at, '%Y-%m-%d') as at, strftime(a.d, '%Y-%m-%d') as last_any, strftime(r.d, '%Y-%m-%d') as last_returned
    from probes p asof left join a on p.k = a.k and p.at >= a.d asof left join r on p.k = r.k and p.at >= r.d
"""


def _asof(spark: SparkSession, sf: str, how) -> DataFrame:
    li = D.table(spark, sf, "lineitem").select(
        "l_orderkey", F.col("l_suppkey").alias("k"), F.to_date("l_shipdate").alias("day"), "l_returnflag"
    )
    orders = D.table(spark, sf, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("at"))
    probes = li.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select("k", "at")
    found = how(probes, li, "k", "at", "day", {"last_any": F.lit(True), "last_returned": F.col("l_returnflag") == "R"})
    return found.select("k", *[F.col(c).cast("string").alias(c) for c in ("at", "last_any", "last_returned")])


@query("asof_latest", _ASOF)
def asof_latest(spark: SparkSession, sf: str) -> DataFrame:
    return _asof(spark, sf, asof.asof_latest)


@query("vehicle_days", O.with_(*O.RUN[:6]) + """
    select reg_canon, strftime(day, '%Y-%m-%d') as day, in_pool, past_service as days_past_service, brake_days, temp_fix from vdays
""")
def vehicle_days(spark: SparkSession, sf: str) -> DataFrame:
    days = run_vehicle_days(spark, sf)
    return days.select(
        "reg_canon", F.col("day").cast("string").alias("day"), "in_pool",
        F.col("vehicle_days_past_service").cast("long").alias("days_past_service"),
        F.col("vehicle_brake_work_days").cast("long").alias("brake_days"), F.col("vehicle_has_active_jugaad").alias("temp_fix"),
    )


def run_vehicle_days(spark: SparkSession, sf: str) -> DataFrame:
    """The facts of every vehicle and day a run asks about."""
    fleet = decision.stage(D.fleet(spark, sf), "fleet")
    admitted, _, _ = decision.admit(D.tickets(spark, sf), fleet, T.DEFAULT_ZONE)
    asked = decision.stage(admitted.select("broken_vehicle_reg", "origin_hub", "day"), "asked")
    return decision.vehicle_days(fleet, D.history(spark, sf), decision.all_probes(fleet, asked))


def _one_fact(name: str, sql: str):
    @query(name, O.with_(*O.RUN[:6]) + f"select ticket_id, {sql} as fact from admitted t join vdays v on t.vehicle_reg = v.reg_canon and t.day = v.day and not v.in_pool")
    def run(spark: SparkSession, sf: str, fact: str = name) -> DataFrame:
        fleet = decision.stage(D.fleet(spark, sf), "fleet")
        admitted, _, _ = decision.admit(D.tickets(spark, sf), fleet, T.DEFAULT_ZONE)
        own = decision.stage(admitted.select("ticket_id", F.col("broken_vehicle_reg").alias("reg_canon"), "day"), "own")
        latest = asof.asof_latest(own, D.history(spark, sf), "reg_canon", "day", "date", decision.history_predicates())
        facts = {
            "days_past_due": asof.days_past_due(F.col("last_service"), F.col("day"), 90).cast("long"),
            "days_since_event": asof.days_since_event(F.col("last_brake"), F.col("day"), 99999).cast("long"),
            "active_within": asof.active_within(F.col("last_temp_fix"), F.col("day"), 7),
        }
        return own.join(latest, ["reg_canon", "day"], "left").select("ticket_id", facts[fact].alias("fact"))

    return run


days_past_due = _one_fact("days_past_due", "past_service")
days_since_event = _one_fact("days_since_event", "brake_days")
active_within = _one_fact("active_within", "temp_fix")


@query("build_facts", O.with_(O.TICKETS, O.FLEET, O.PEOPLE, O.ADMITTED) + """
    select ticket_id, mon as month_in, night as is_night_dispatch, client as client_is, known_driver, tenure as driver_months_tenure,
      origin_hub || case when dest_hub is not null then '>' || dest_hub else '' end as route, hill as route_is_hill, east as route_east_of_lucknow from admitted
""")
def build_facts(spark: SparkSession, sf: str) -> DataFrame:
    admitted, _, _ = decision.admit(D.tickets(spark, sf), D.fleet(spark, sf), T.DEFAULT_ZONE)
    return decision.build_facts(admitted, D.people(spark, sf)).select(
        "ticket_id", "month_in", "is_night_dispatch", "client_is", "known_driver", "driver_months_tenure",
        F.array_join("route_touches", ">").alias("route"), "route_is_hill", "route_east_of_lucknow",
    )


@query("previous_in_sequence", TK + """
    select pos, lag(vehicle_reg) over (partition by client order by ats, pos) as previous from tickets
    where client is not null and ats is not null
""")
def previous_in_sequence(spark: SparkSession, sf: str) -> DataFrame:
    t = D.tickets(spark, sf).select("pos", "client", "created_at", "vehicle_reg").filter("client is not null and created_at is not null")
    return asof.previous_in_sequence(t, "client", "created_at", "pos", "vehicle_reg").select("pos", "previous")


# --- checks --------------------------------------------------------------------------------------------


@query("check_unique", """
    select count(*) as n_keys, cast(sum(n) as bigint) as n_rows, count_if(n > 1) as n_repeated
    from (select count(*) as n from lineitem group by l_orderkey, l_linenumber)
""")
def check_unique(spark: SparkSession, sf: str) -> DataFrame:
    return checks.check_unique(D.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("check_one_to_one", """
    select coalesce(o.k, l.k) as k, cast(coalesce(o.n, 0) as bigint) as n_left, cast(coalesce(l.n, 0) as bigint) as n_right
    from (select o_orderkey as k, count(*) as n from orders group by 1) o
    full join (select l_orderkey as k, count(*) as n from lineitem group by 1) l on o.k = l.k
    where coalesce(o.n, 0) <> 1 or coalesce(l.n, 0) <> 1
""")
def check_one_to_one(spark: SparkSession, sf: str) -> DataFrame:
    left = D.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"))
    right = D.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"))
    return checks.check_one_to_one(left, right, ["k"])


@query("check_not_blank", TK + "select count(*) as n_rows, count_if(client is null) as n_blank from tickets")
def check_not_blank(spark: SparkSession, sf: str) -> DataFrame:
    return checks.check_not_blank(D.tickets(spark, sf), "client")


@query("check_identifiable", TK + "select count(*) as n_records, count_if(ticket_id is null) as n_unidentifiable from tickets")
def check_identifiable(spark: SparkSession, sf: str) -> DataFrame:
    return checks.check_identifiable(D.tickets(spark, sf), "ticket_id")


@query("reconcile", "select distinct o_custkey as c from orders where o_custkey not in (select doc_id from documents) and o_custkey not in (select user_id from events)")
def reconcile(spark: SparkSession, sf: str) -> DataFrame:
    expected = D.table(spark, sf, "orders").select(F.col("o_custkey").alias("c"))
    docs = D.table(spark, sf, "documents").select(F.col("doc_id").alias("c"))
    users = D.table(spark, sf, "events").select(F.col("user_id").alias("c"))
    return checks.reconcile(expected, "c", docs, users)


@query("reconcile_run", O.with_(O.TICKETS, O.FLEET, O.PEOPLE, O.ADMITTED) + """
    select distinct ticket_id from tickets where ticket_id is not null and ticket_id not in (select ticket_id from admitted)
      and ticket_id not in (select ticket_id from first_t where ticket_id is not null and (vehicle_reg is null or origin_hub is null or ats is null))
      and ticket_id not in (select ticket_id from usable where vehicle_reg not in (select reg_canon from fleet))
""")
def reconcile_run(spark: SparkSession, sf: str) -> DataFrame:
    t = D.tickets(spark, sf)
    places = decision.admit(t, D.fleet(spark, sf), T.DEFAULT_ZONE)
    return checks.reconcile(t.select("ticket_id"), "ticket_id", *[p.select("ticket_id") for p in places])


_PRINTED = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "note"]


@query("content_fingerprint", f"""
    with t as (select *, case when l_partkey % 3 = 0 then null else l_returnflag end as note from lineitem),
    h as (select cast('0x' || substr(sha256(concat_ws(chr(31), {', '.join(f"coalesce(cast({c} as varchar), chr(30))" for c in _PRINTED)})), 1, 15) as bigint) as h from t)
    select count(*) as n_rows, bit_xor(h) as xor_hash, cast(sum(h & 4294967295) as bigint) as sum_hash from h
""")
def fingerprint(spark: SparkSession, sf: str) -> DataFrame:
    rows = D.table(spark, sf, "lineitem").withColumn("note", F.when(F.col("l_partkey") % 3 != 0, F.col("l_returnflag")))
    return content_fingerprint(rows, _PRINTED)


@query("check_replay", "select count(*) as n_first, count(*) as n_second, true as same from lineitem")
def check_replay(spark: SparkSession, sf: str) -> DataFrame:
    li = D.table(spark, sf, "lineitem")
    return checks.check_replay(li, li.orderBy(F.col("l_extendedprice").desc()))


@query("ingest_report", O.with_(O.TICKETS, O.FLEET, O.PEOPLE) + """
    select 'fleet' as source, cast(sum(n_rows) as bigint) as n_rows, count(*) as n_entities from fleet
    union all select 'people', count(*), count(distinct driver_id) from people
    union all select 'tickets', count(*), count(distinct ticket_id) + count_if(ticket_id is null) from tickets
""")
def ingest_report(spark: SparkSession, sf: str) -> DataFrame:
    t = D.tickets(spark, sf)
    return checks.ingest_report({
        "fleet": (D.raw_fleet(spark, sf), D.fleet(spark, sf)),
        "people": (D.raw_people(spark, sf), D.people(spark, sf)),
        "tickets": (t, dedupe.dedupe_first(t, ["ticket_id"], ["pos"])),
    })

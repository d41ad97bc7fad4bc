"""Queries over single columns: canonical forms, times and flags."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica import vocabulary as V
from adjudica.functions import canonical as C
from adjudica.functions import temporal as T
from adjudica.operators import asof
from adjudica.plans import decision
from adjudica.plans import domain as D
from adjudica.plans import oracle as O
from adjudica.plans.registry import query

TK = O.with_(O.TICKETS)


@query("norm_key", TK + "select pos, vehicle_reg from tickets")
def norm_key(spark: SparkSession, sf: str) -> DataFrame:
    return D.raw_tickets(spark, sf).select("pos", C.norm_key("vehicle").alias("vehicle_reg"))


@query("norm_alias", TK + "select pos, client from tickets")
def norm_alias(spark: SparkSession, sf: str) -> DataFrame:
    return D.raw_tickets(spark, sf).select("pos", C.norm_alias("client").alias("client"))


@query("norm_alias_join", TK + "select pos, client from tickets")
def norm_alias_join(spark: SparkSession, sf: str) -> DataFrame:
    aliases = spark.createDataFrame(list(V.PARTY_ALIASES.items()), "alias string, canonical string")
    raw = D.raw_tickets(spark, sf).select("pos", "client")
    return C.norm_alias_join(raw, "client", aliases, "out").select("pos", F.col("out").alias("client"))


@query("norm_place", TK + "select pos, origin_hub, dest_hub from tickets")
def norm_place(spark: SparkSession, sf: str) -> DataFrame:
    return D.raw_tickets(spark, sf).select(
        "pos", C.norm_place("origin_hub").alias("origin_hub"), C.norm_place("destination").alias("dest_hub")
    )


@query("norm_num", TK + "select pos, km from tickets")
def norm_num(spark: SparkSession, sf: str) -> DataFrame:
    return D.raw_tickets(spark, sf).select("pos", C.norm_num("km_from_origin_hub").alias("km"))


@query("norm_bool", """
    select s_suppkey * 3 + c as source_row,
      case when c = 4 then null else case s_suppkey % 4 when 0 then true when 1 then false when 2 then true end end as heater
    from supplier join (select unnest([2, 3, 4]) as c) on c = 3 or (c = 4 and s_suppkey % 5 = 0) or (c = 2 and s_suppkey % 15 = 0)
""")
def norm_bool(spark: SparkSession, sf: str) -> DataFrame:
    return D.raw_fleet(spark, sf).select("source_row", C.norm_bool("engine_heater").alias("heater"))


@query("norm_enum", TK + "select pos, severity from tickets")
def norm_enum(spark: SparkSession, sf: str) -> DataFrame:
    return D.raw_tickets(spark, sf).select("pos", C.norm_enum("severity").alias("severity"))


@query("norm_stage", """
    select s_suppkey * 3 + c as source_row, case when s_suppkey % 3 = 0 then 'BS4' else 'BS6' end as bs_stage
    from supplier join (select unnest([2, 3, 4]) as c) on c = 3 or (c = 4 and s_suppkey % 5 = 0) or (c = 2 and s_suppkey % 15 = 0)
""")
def norm_stage(spark: SparkSession, sf: str) -> DataFrame:
    return D.raw_fleet(spark, sf).select("source_row", C.norm_stage("bs_stage").alias("bs_stage"))


@query("norm_prefixed_id", O.with_(O.PEOPLE) + "select source_row, driver_id from people")
def norm_prefixed_id(spark: SparkSession, sf: str) -> DataFrame:
    return D.raw_people(spark, sf).select("source_row", C.norm_prefixed_id("driver_id").alias("driver_id"))


@query("classify_text", TK + "select pos, issue from tickets")
def classify_text(spark: SparkSession, sf: str) -> DataFrame:
    return D.raw_tickets(spark, sf).select("pos", C.classify_text("issue").alias("issue"))


@query("parse_ts", TK + """
    select pos, strftime(ats, '%Y-%m-%d %H:%M:%S') as local_time,
      strftime(ats - interval 330 minute, '%Y-%m-%dT%H:%M:%S') || '.000Z' as utc_time from tickets
""")
def parse_ts(spark: SparkSession, sf: str) -> DataFrame:
    parsed = D.raw_tickets(spark, sf).select("pos", T.parse_ts("created_at").alias("ts"))
    return parsed.select(
        "pos", F.date_format(T.wall_clock("ts"), "yyyy-MM-dd HH:mm:ss").alias("local_time"), T.utc_text("ts").alias("utc_time")
    )


@query("parse_serial", """
    select o_orderkey as k, strftime(o_orderdate + interval 20 year + to_hours(cast(o_orderkey % 4 * 6 as integer)) - interval 330 minute,
      '%Y-%m-%dT%H:%M:%S') || '.000Z' as utc_time from orders
""")
def parse_serial(spark: SparkSession, sf: str) -> DataFrame:
    serial = "datediff(to_date(o_orderdate + interval 20 year), date'1899-12-30') + (o_orderkey % 4) * 0.25d"
    orders = D.table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.expr(serial).alias("serial"))
    return orders.select("k", T.utc_text(T.parse_serial("serial")).alias("utc_time"))


@query("local_date", TK + "select pos, strftime(ats, '%Y-%m-%d') as day from tickets")
def local_date(spark: SparkSession, sf: str) -> DataFrame:
    return D.raw_tickets(spark, sf).select("pos", T.local_date(T.parse_ts("created_at")).cast("string").alias("day"))


@query("local_hour", TK + "select pos, cast(hour(ats) as integer) as hour from tickets")
def local_hour(spark: SparkSession, sf: str) -> DataFrame:
    return D.raw_tickets(spark, sf).select("pos", T.local_hour(T.parse_ts("created_at")).alias("hour"))


@query("days_between", """
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(datediff('day', o_orderdate, l_shipdate) as integer) as days
    from lineitem join orders on l_orderkey = o_orderkey
""")
def days_between(spark: SparkSession, sf: str) -> DataFrame:
    li = D.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    o = D.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        T.days_between(F.to_date("o_orderdate"), F.to_date("l_shipdate")).alias("days"),
    )


@query("any_member", TK + """
    select pos, coalesce(origin_hub in ('rudrapur', 'nainital', 'haldwani'), false) or dest_hub in ('rudrapur', 'nainital', 'haldwani') as hill,
      coalesce(origin_hub in ('delhi', 'gurgaon', 'faridabad', 'noida'), false) or dest_hub in ('delhi', 'gurgaon', 'faridabad', 'noida') as restricted
    from tickets
""")
def any_member(spark: SparkSession, sf: str) -> DataFrame:
    routed = D.tickets(spark, sf).select("pos", F.array_compact(F.array("origin_hub", "dest_hub")).alias("route"))
    return routed.select(
        "pos", C.any_member("route", V.HILL_PLACES).alias("hill"), C.any_member("route", V.RESTRICTED_PLACES).alias("restricted")
    )


@query("calendar_flags", TK + """
    select pos, cast(month(ats) as integer) as month_in, hour(ats) >= 20 or hour(ats) < 6 as is_night_dispatch from tickets
""")
def calendar_flags(spark: SparkSession, sf: str) -> DataFrame:
    flagged = D.tickets(spark, sf).select("pos", "created_at").withColumns(decision.calendar_facts())
    return flagged.select("pos", "month_in", "is_night_dispatch")


@query("calendar_flags_events", """
    select event_id, cast(month(ts + interval 330 minute) as integer) as month_in, cast(hour(ts + interval 330 minute) as integer) as hour,
      hour(ts + interval 330 minute) >= 20 or hour(ts + interval 330 minute) < 6 as is_night from events
""")
def calendar_flags_events(spark: SparkSession, sf: str) -> DataFrame:
    events = D.table(spark, sf, "events").select("event_id", T.instant("ts", "UTC").alias("at"))
    local = events.select("event_id", T.local_hour("at").alias("hour"), F.month(T.local_date("at")).alias("month_in"))
    return local.select("event_id", "month_in", "hour", T.is_night("hour").alias("is_night"))


@query("tenure_months", O.with_(O.TICKETS, O.PEOPLE) + """
    select pos, cast(floor(datediff('day', joined, cast(ats as date)) / 30.4375::double) as integer) as months
    from tickets left join people using (driver_id)
""")
def tenure_months(spark: SparkSession, sf: str) -> DataFrame:
    t = D.tickets(spark, sf).select("pos", "driver_id", T.local_date("created_at").alias("day"))
    p = D.people(spark, sf).select("driver_id", "joining_date")
    return t.join(p, "driver_id", "left").select("pos", T.tenure_months("joining_date", "day").alias("months"))


@query("normalize_vehicle_row", """
    select s_suppkey * 3 + c as source_row, reg_canon,
      case when c = 3 then 'V-' || s_suppkey end as vehicle_id,
      case when c = 2 then 'Early' when s_suppkey % 4 < 3 then list_extract(['LPT 1613', 'Ecomet 1215', 'Pro 2095'], cast(s_suppkey % 4 as integer) + 1) end as model,
      cast(2014 + s_suppkey % 10 + case when c = 2 then 2 when c = 4 and s_suppkey % 10 = 0 then 1 else 0 end as integer) as year,
      case when s_suppkey % 3 = 0 then 'BS4' else 'BS6' end as bs_stage,
      case when c < 4 then case s_suppkey % 4 when 0 then true when 1 then false when 2 then true end end as engine_heater,
      home_hub,
      case when c = 4 then 20.0::double when s_suppkey % 7 <> 0 then 9.5::double + s_suppkey % 5 end as capacity_tonnes
    from (select *, """ + O.reg("s_suppkey") + " as reg_canon, " + O.pick(O.HUBS, "s_nationkey") + """ as home_hub from supplier)
    join (select unnest([2, 3, 4]) as c) on c = 3 or (c = 4 and s_suppkey % 5 = 0) or (c = 2 and s_suppkey % 15 = 0)
""")
def normalize_vehicle_row(spark: SparkSession, sf: str) -> DataFrame:
    return D.fleet_rows(D.raw_fleet(spark, sf)).select("source_row", "reg_canon", *D.MERGE_FIELDS)


@query("normalize_ticket", TK + """
    select pos, ticket_id, strftime(ats, '%Y-%m-%d %H:%M') as created_local, vehicle_reg, driver_id, origin_hub, dest_hub, km,
      issue, severity, client, status, note from tickets
""")
def normalize_ticket(spark: SparkSession, sf: str) -> DataFrame:
    return D.tickets(spark, sf).select(
        "pos", "ticket_id", F.date_format(T.wall_clock("created_at"), "yyyy-MM-dd HH:mm").alias("created_local"),
        "vehicle_reg", "driver_id", "origin_hub", "dest_hub", F.col("km_from_origin").alias("km"), "issue",
        F.col("severity_reported").alias("severity"), "client", "status", F.col("resolution_note").alias("note"),
    )


@query("null_gaps", TK + """
    select pos, concat_ws(',', case when ticket_id is null then 'ticket_id' end, case when ats is null then 'created_at' end,
      case when vehicle_reg is null then 'vehicle_reg' end, case when driver_id is null then 'driver_id' end,
      case when origin_hub is null then 'origin_hub' end, case when km is null then 'km_from_origin' end,
      case when severity is null then 'severity_reported' end, case when client is null then 'client' end) as gaps
    from tickets
""")
def null_gaps(spark: SparkSession, sf: str) -> DataFrame:
    names = ["ticket_id", "created_at", "vehicle_reg", "driver_id", "origin_hub", "km_from_origin", "severity_reported", "client"]
    return D.tickets(spark, sf).select("pos", F.array_join(asof.null_gaps(names), ",").alias("gaps"))

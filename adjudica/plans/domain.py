"""The decision tables, derived row by row from the benchmark tables.

The derivation makes them dirty on purpose (spellings, copies, gaps, bad dates, personal data), by
fixed expressions over the keys, so every row of the source tables takes part and no result depends
on chance.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.functions import canonical as C
from adjudica.functions import privacy as P
from adjudica.functions import temporal as T
from adjudica.functions.identity import row_text
from adjudica.operators import dedupe, resolve
from adjudica.plans.decision import Inputs
from adjudica.session import spread

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()
SALT = "example-salt"
HUBS = [
    "Ambala", "Chandigarh WH", "New Delhi (North)", "Gurugram Depot", "Jaipur", "Kanpur hub", "LUCKNOW.",
    "Ludhiana WH", "Rudrapur yard",
]
DESTINATIONS = [*HUBS, "Nainital", "Haldwani", "Gorakhpur", "Patna"]
PARTIES = {
    "AUTOMOBILE": "Shakti Cement Pvt. Ltd.",
    "BUILDING": "ORION Pharma",
    "FURNITURE": "Vertex Retail Limited",
    "MACHINERY": "apex chem",
}
ISSUES = [
    "brake pad worn", "leaf spring broken", "steering hard", "clutch plate slipping", "front tyre puncture",
    "coolant leak", "garam ho raha", "strange noise",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One source table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus, spread for per-text work."""
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"))


def _pick(values: list[str], index: str) -> str:
    listed = ", ".join("'" + v.replace("'", "''") + "'" for v in values)
    return f"element_at(array({listed}), cast(({index}) % {len(values)} as int) + 1)"


def _reg(n: str) -> str:
    padded = f"lpad(cast({n} as string), greatest(4, length(cast({n} as string))), '0')"
    return f"concat('HR', lpad(cast({n} % 97 as string), 2, '0'), 'K', char(cast(65 + {n} % 26 as int)), {padded})"


def raw_fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fleet register rows: a master row per supplier, and id-less copies of some before or after it."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    copies = """
      case when s_suppkey % 15 = 0 then array(2, 3, 4)
           when s_suppkey % 5 = 0 then array(3, 4) else array(3) end
    """
    rows = s.withColumn("copy", F.explode(F.expr(copies)))
    reg = _reg("s_suppkey")
    return rows.selectExpr(
        "case when copy = 3 then concat('V-', s_suppkey) end as vehicle_id",
        f"""case copy when 2 then lower({reg})
            when 4 then concat(substr({reg}, 1, 2), ' ', substr({reg}, 3, 4), '-', substr({reg}, 7))
            else {reg} end as registration_number""",
        f"case when copy = 2 then 'Early' else {_pick(['LPT 1613', 'Ecomet 1215', 'Pro 2095', ''], 's_suppkey')} end as model",
        "cast(2014 + s_suppkey % 10 + case when copy = 2 then 2 when copy = 4 and s_suppkey % 10 = 0 then 1 else 0 end as string) as year",
        "case when s_suppkey % 3 = 0 then 'bs-4' else 'Bs 6' end as bs_stage",
        "case when copy = 4 then '' else element_at(array('Yes', 'no', 'Haan', ''), cast(s_suppkey % 4 as int) + 1) end as engine_heater",
        f"{_pick(HUBS, 's_nationkey')} as home_hub",
        "case when copy = 4 then '20 t' when s_suppkey % 7 = 0 then '' else concat(9 + s_suppkey % 5, '.5 t') end as capacity_tonnes",
        "'fleet.csv' as source_file",
        "s_suppkey * 3 + copy as source_row",
    )


def fleet_rows(raw: DataFrame) -> DataFrame:
    """Register rows in canonical form."""
    return raw.select(
        C.norm_key("registration_number").alias("reg_canon"),
        C.blank_to_null("vehicle_id").alias("vehicle_id"),
        C.blank_to_null("model").alias("model"),
        C.norm_num("year").cast("int").alias("year"),
        C.norm_stage("bs_stage").alias("bs_stage"),
        C.norm_bool("engine_heater").alias("engine_heater"),
        C.norm_place("home_hub").alias("home_hub"),
        C.norm_num("capacity_tonnes").alias("capacity_tonnes"),
        "source_file", "source_row",
        F.col("registration_number").alias("raw_reg"),
    )


MERGE_FIELDS = ["vehicle_id", "model", "year", "bs_stage", "engine_heater", "home_hub", "capacity_tonnes"]


def fleet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fleet, one row per vehicle."""
    rows = fleet_rows(raw_fleet(spark, sf_dir))
    return resolve.resolve_entities(rows, "reg_canon", "vehicle_id", "source_row", MERGE_FIELDS)


def raw_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maintenance log rows from line items. Few vehicles carry most of the log, some carry none."""
    li = spread(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_returnflag", "l_extendedprice"
        )
    )
    owner = li.withColumn(
        "owner", F.expr("case when l_linenumber = 1 then l_suppkey else l_suppkey - l_suppkey % 7 end")
    ).withColumn("owner", F.expr("case when owner % 11 = 10 then 0 else owner end"))
    return owner.selectExpr(
        "date_format(l_shipdate + interval 20 year, 'yyyy-MM-dd') as date",
        f"lower({_reg('owner')}) as vehicle",
        "case when l_partkey % 13 = 0 then 'unknown' else concat(l_orderkey % 90000 + 1000, ' km') end as odometer_km",
        "concat('M', l_partkey % 20) as mechanic",
        """concat(case when l_partkey % 40 = 0 then 'brake pads changed'
                when l_partkey % 41 = 0 then 'jugaad on hose, permanent repair pending'
                when l_partkey % 43 = 0 then 'jugaad done'
                else concat('routine check ', l_returnflag) end,
             case when l_partkey % 50 = 7 then concat(' call 98', lpad(cast(l_partkey as string), 8, '0')) else '' end) as notes""",
        "'history.csv' as source_file",
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
    )


HISTORY_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def history_rows(raw: DataFrame, salt: str = SALT) -> DataFrame:
    """Log rows in canonical form, notes masked, rows without a vehicle dropped."""
    return raw.select(
        T.parse_date("date").alias("date"),
        C.norm_key("vehicle").alias("reg_canon"),
        C.norm_num("odometer_km").cast("long").alias("odometer_km"),
        C.blank_to_null("mechanic").alias("mechanic"),
        P.mask_text("notes", salt).alias("notes"),
        *HISTORY_ORDER,
    ).filter("reg_canon is not null")


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log for as-of questions; repeated entries change none of their answers, so they may stay."""
    return history_rows(raw_history(spark, sf_dir))


def raw_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roster rows from customers, with personal data in several spellings."""
    c = spread(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"))
    ten = "lpad(cast(c_custkey % 100000000 as string), 8, '0')"
    return c.selectExpr(
        "concat(case when c_custkey % 2 = 0 then 'drv ' else 'DRV--' end, c_custkey) as driver_id",
        "c_name as name",
        f"case when c_custkey % 3 = 0 then concat('+91 98', substr({ten}, 1, 3), ' ', substr({ten}, 4)) else concat('98', {ten}) end as phone",
        f"concat('HR-', lpad(cast(c_custkey % 100 as string), 2, '0'), ' 201', {ten}) as dl_number",
        f"concat('4444 ', substr({ten}, 1, 4), ' ', substr({ten}, 5)) as aadhaar",
        """case when c_custkey % 2 = 0
             then date_format(date_add(date'2014-01-01', cast(c_custkey * 37 % 4000 as int)), 'yyyy-MM-dd')
             else date_format(date_add(date'2014-01-01', cast(c_custkey * 37 % 4000 as int)), 'dd/MM/yyyy') end as joining_date""",
        f"{_pick(HUBS, 'c_nationkey')} as home_hub",
        "c_custkey + 2 as source_row",
    )


def people_rows(raw: DataFrame, salt: str = SALT, width: int = P.TOKEN_WIDTH) -> DataFrame:
    """Roster rows in canonical form, three columns masked, the result gated."""
    rows = raw.select(
        C.norm_prefixed_id("driver_id").alias("driver_id"),
        C.blank_to_null("name").alias("name"),
        P.mask_column("phone", "PHONE", salt, width).alias("phone_masked"),
        P.mask_column("dl_number", "DL", salt, width).alias("dl_masked"),
        P.mask_column("aadhaar", "AADHAAR", salt, width).alias("aadhaar_masked"),
        T.parse_date("joining_date").alias("joining_date"),
        C.norm_place("home_hub").alias("home_hub"),
        "source_row",
    ).filter("driver_id is not null")
    return P.gate_clean(rows, ["name", "phone_masked", "dl_masked", "aadhaar_masked"], "roster")


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roster, last row per person."""
    return dedupe.upsert_last(people_rows(raw_people(spark, sf_dir)), ["driver_id"], ["source_row"])


def _raw_tickets_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spread(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    )
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    # One row, one number: how many vehicles there are.
    size = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1)).alias("n"))
    joined = o.join(c, F.col("o_custkey") == F.col("c_custkey")).withColumn("ns", size.scalar())
    return joined.withColumn("sv", F.expr("(o_orderkey * 7919 + 13) % (ns + 3)")).withColumn(
        "ts", F.expr("o_orderdate + interval 20 year + make_dt_interval(0, cast(o_orderkey % 24 as int), cast(o_orderkey % 60 as int))")
    ).withColumn("copy", F.explode(F.expr("case when o_orderkey % 17 = 0 then array(0, 1) else array(0) end")))


def raw_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queue records from orders; some come twice, some first copies are broken."""
    base = _raw_tickets_base(spark, sf_dir)
    reg = f"case when sv >= ns then concat('ZZ99ZZ', sv) else {_reg('sv')} end"
    party = " ".join(f"when '{k}' then '{v}'" for k, v in PARTIES.items())
    return base.selectExpr(
        "case when o_orderkey % 101 <> 7 then concat(' TKT-', o_orderkey, ' ') end as ticket_id",
        """case when o_orderkey % 89 = 3 or (copy = 0 and o_orderkey % 34 = 0) then 'not-a-date'
             when o_orderkey % 4 = 0 then date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
             when o_orderkey % 4 = 1 then concat(date_format(ts, 'EEE, dd MMM yyyy HH:mm'), ' +0530')
             when o_orderkey % 4 = 2 then date_format(ts - interval '5:30' hour to minute, "yyyy-MM-dd'T'HH:mm:ss'Z'")
             else date_format(ts, 'yyyy-MM-dd HH:mm') end as created_at""",
        f"""case when o_orderkey % 97 = 5 then '' when o_orderkey % 3 = 0 then lower({reg})
             when o_orderkey % 3 = 1 then concat(substr({reg}, 1, 4), '-', substr({reg}, 5)) else {reg} end as vehicle""",
        "case when o_orderkey % 53 <> 9 then concat('drv ', o_custkey) end as driver_id",
        f"case when o_orderkey % 83 = 2 then '' else {_pick(HUBS, 'c_nationkey')} end as origin_hub",
        f"{_pick(DESTINATIONS, 'o_orderkey')} as destination",
        """case when o_orderkey % 29 = 4 then 'unknown' when o_orderkey % 2 = 0 then concat(o_orderkey * 31 % 120, ' km')
             else concat(o_orderkey * 31 % 120, '.5') end as km_from_origin_hub""",
        f"{_pick(ISSUES, 'o_orderkey')} as issue",
        "case o_orderpriority when '1-URGENT' then ' high ' when '2-HIGH' then 'HIGH' when '3-MEDIUM' then 'Medium' when '5-LOW' then 'low' else 'unset' end as severity",
        f"case c_mktsegment {party} else case when o_orderkey % 2 = 0 then 'Internal' else '' end end as client",
        "lower(o_orderstatus) as status",
        "case when copy = 1 then '(sync copy)' else '' end as resolution_note",
        "o_orderkey * 2 + copy as pos",
    )


QUEUE_FIELDS = [
    "ticket_id", "created_at", "vehicle", "driver_id", "origin_hub", "destination", "km_from_origin_hub", "issue",
    "severity", "client", "status", "resolution_note",
]


def ticket_rows(raw: DataFrame, zone: str = T.DEFAULT_ZONE, text: Column | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Queue records in canonical form, with the raw record as text for the quarantine to mask.

    ``text`` is the record as it came, if the caller has it; ``keep`` names further columns to keep.
    """
    return raw.select(
        C.blank_to_null(F.trim("ticket_id")).alias("ticket_id"),
        T.parse_ts("created_at", zone).alias("created_at"),
        C.norm_key("vehicle").alias("vehicle_reg"),
        C.norm_prefixed_id("driver_id").alias("driver_id"),
        C.norm_place("origin_hub").alias("origin_hub"),
        C.norm_place("destination").alias("dest_hub"),
        C.norm_num("km_from_origin_hub").alias("km_from_origin"),
        C.classify_text("issue").alias("issue"),
        C.norm_enum("severity").alias("severity_reported"),
        C.norm_alias("client").alias("client"),
        C.blank_to_null(F.upper(F.trim("status"))).alias("status"),
        C.blank_to_null("resolution_note").alias("resolution_note"),
        "pos",
        (row_text(QUEUE_FIELDS) if text is None else text).alias("raw_json"),
        *keep,
    )


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The queue in canonical form."""
    return ticket_rows(raw_tickets(spark, sf_dir))


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """Everything one run needs."""
    return Inputs(tickets(spark, sf_dir), fleet(spark, sf_dir), history(spark, sf_dir), people(spark, sf_dir))

"""SQL for an independent engine: what the derived tables hold, stated from the source keys.

Nothing here repeats the Spark plans. The dirty tables are built so that every canonical value is a
closed formula of the keys; candidates are judged pair by pair.
"""

from __future__ import annotations

HUBS = ["ambala", "chandigarh", "delhi", "gurgaon", "jaipur", "kanpur", "lucknow", "ludhiana", "rudrapur"]
DESTS = [*HUBS, "nainital", "haldwani", "gorakhpur", "patna"]
ISSUES = ["brake", "suspension", "steering", "gearbox", "tyre", "radiator", "engine", "other"]


def pick(values: list[str], index: str) -> str:
    return "list_extract([" + ", ".join(f"'{v}'" for v in values) + f"], cast(({index}) % {len(values)} as integer) + 1)"


def reg(n: str) -> str:
    return (
        f"('HR' || lpad(cast({n} % 97 as varchar), 2, '0') || 'K' || chr(cast(65 + {n} % 26 as integer)) || "
        f"lpad(cast({n} as varchar), cast(greatest(4, length(cast({n} as varchar))) as integer), '0'))"
    )


def padded(n: str, width: int = 3) -> str:
    return f"lpad(cast({n} as varchar), cast(greatest({width}, length(cast({n} as varchar))) as integer), '0')"


def token(kind: str, canonical: str, width: int = 16) -> str:
    return f"('[{kind}:' || substr(sha256('example-salt|{kind}|' || {canonical}), 1, {width}) || ']')"


NUM = "regexp_replace(cast({} as varchar), '\\.0$', '')"

TICKETS = f"""
ns as (select count(*) as n from supplier),
raw_t as (
  select o_orderkey as k, o_custkey, c_nationkey, c_mktsegment, o_orderstatus, o_orderpriority, cp.copy, n,
    (o_orderkey * 7919 + 13) % (n + 3) as sv,
    o_orderdate + interval 20 year + to_hours(cast(o_orderkey % 24 as integer)) + to_minutes(cast(o_orderkey % 60 as integer)) as ts
  from orders join customer on o_custkey = c_custkey cross join ns
  join (select 0 as copy union all select 1) cp on cp.copy = 0 or o_orderkey % 17 = 0
),
tickets as (
  select k, copy, k * 2 + copy as pos,
    case when k % 101 <> 7 then 'TKT-' || k end as ticket_id,
    case when k % 89 = 3 or (copy = 0 and k % 34 = 0) then null else ts end as ats,
    case when k % 97 = 5 then null when sv >= n then 'ZZ99ZZ' || sv else {reg('sv')} end as vehicle_reg,
    case when k % 53 <> 9 then 'DRV-' || {padded('o_custkey')} end as driver_id,
    case when k % 83 = 2 then null else {pick(HUBS, 'c_nationkey')} end as origin_hub,
    {pick(DESTS, 'k')} as dest_hub,
    case when k % 29 = 4 then null when k % 2 = 0 then cast(k * 31 % 120 as double) else k * 31 % 120 + 0.5::double end as km,
    {pick(ISSUES, 'k')} as issue,
    case o_orderpriority when '1-URGENT' then 'HIGH' when '2-HIGH' then 'HIGH' when '3-MEDIUM' then 'MEDIUM' when '5-LOW' then 'LOW' end as severity,
    case c_mktsegment when 'AUTOMOBILE' then 'shakti_cement' when 'BUILDING' then 'orion_pharma' when 'FURNITURE' then 'vertex_retail'
      when 'MACHINERY' then 'apex_chemicals' else case when k % 2 = 0 then 'internal' end end as client,
    upper(o_orderstatus) as status, case when copy = 1 then '(sync copy)' end as note
  from raw_t
)"""

FLEET = f"""
fleet as (
  select s_suppkey as s, {reg('s_suppkey')} as reg_canon, 'V-' || s_suppkey as vehicle_id,
    case when s_suppkey % 4 < 3 then {pick(['LPT 1613', 'Ecomet 1215', 'Pro 2095', ''], 's_suppkey')} when s_suppkey % 15 = 0 then 'Early' end as model,
    cast(2014 + s_suppkey % 10 as integer) as year,
    case when s_suppkey % 3 = 0 then 'BS4' else 'BS6' end as bs_stage,
    case s_suppkey % 4 when 0 then true when 1 then false when 2 then true end as heater,
    {pick(HUBS, 's_nationkey')} as home_hub,
    case when s_suppkey % 7 <> 0 then 9.5::double + s_suppkey % 5 when s_suppkey % 5 = 0 then 20.0::double end as capacity,
    case when s_suppkey % 15 = 0 then 3 when s_suppkey % 5 = 0 then 2 else 1 end as n_rows
  from supplier
)"""

CONFLICTS = """
conflicts as (
  select reg_canon, 'year' as field, cast(year as varchar) as winner, s * 3 + 3 as winner_row,
    cast(case when s % 10 = 0 then year + 1 else year + 2 end as varchar) as loser,
    case when s % 10 = 0 then s * 3 + 4 else s * 3 + 2 end as loser_row
  from fleet where s % 10 = 0 or s % 15 = 0
  union all
  select reg_canon, 'model', model, s * 3 + 3, 'Early', s * 3 + 2 from fleet where s % 15 = 0 and s % 4 < 3
  union all
  select reg_canon, 'capacity_tonnes', regexp_replace(cast(capacity as varchar), '\\.0$', ''), s * 3 + 3, '20', s * 3 + 4
  from fleet where s % 5 = 0 and s % 7 <> 0
)"""

HISTORY = f"""
owners as (
  select *, case when o % 11 = 10 then 0 else o end as owner
  from (select *, case when l_linenumber = 1 then l_suppkey else l_suppkey - l_suppkey % 7 end as o from lineitem)
),
history as (
  select {reg('owner')} as reg_canon, cast(l_shipdate + interval 20 year as date) as day, l_partkey as p,
    case when l_partkey % 13 <> 0 then l_orderkey % 90000 + 1000 end as odometer,
    'M' || (l_partkey % 20) as mechanic,
    case when l_partkey % 40 = 0 then 'brake pads changed' when l_partkey % 41 = 0 then 'jugaad on hose, permanent repair pending'
      when l_partkey % 43 = 0 then 'jugaad done' else 'routine check ' || l_returnflag end
      || case when l_partkey % 50 = 7 then ' call ' || {token('PHONE', "'98' || lpad(cast(l_partkey as varchar), 8, '0')")} else '' end as notes,
    l_partkey % 40 = 0 as is_brake, l_partkey % 40 <> 0 and l_partkey % 41 = 0 as is_temp_fix,
    l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice
  from owners
)"""

PEOPLE = f"""
people as (
  select 'DRV-' || {padded('c_custkey')} as driver_id, c_name as name, cast(date '2014-01-01' + cast(c_custkey * 37 % 4000 as integer) as date) as joined,
    {pick(HUBS, 'c_nationkey')} as home_hub, c_custkey + 2 as source_row,
    {token('PHONE', "'98' || lpad(cast(c_custkey % 100000000 as varchar), 8, '0')")} as phone_masked,
    {token('DL', "'HR' || lpad(cast(c_custkey % 100 as varchar), 2, '0') || '201' || lpad(cast(c_custkey % 100000000 as varchar), 8, '0')")} as dl_masked,
    {token('AADHAAR', "'4444' || lpad(cast(c_custkey % 100000000 as varchar), 8, '0')")} as aadhaar_masked
  from customer
)"""

ADMITTED = """
first_t as (
  select * from tickets where ticket_id is null
  union all
  select * from tickets where ticket_id is not null qualify row_number() over (partition by ticket_id order by pos) = 1
),
usable as (
  select * from first_t where ticket_id is not null and vehicle_reg is not null and origin_hub is not null and ats is not null
),
admitted as (
  select u.*, cast(u.ats as date) as day, cast(month(u.ats) as integer) as mon, hour(u.ats) >= 20 or hour(u.ats) < 6 as night,
    f.home_hub as own_hub, p.driver_id as known_driver,
    cast(floor(datediff('day', p.joined, cast(u.ats as date)) / 30.4375::double) as integer) as tenure,
    origin_hub in ('rudrapur', 'nainital', 'haldwani') or dest_hub in ('rudrapur', 'nainital', 'haldwani') as hill,
    origin_hub in ('delhi', 'gurgaon', 'faridabad', 'noida') or dest_hub in ('delhi', 'gurgaon', 'faridabad', 'noida') as ncr,
    dest_hub in ('gorakhpur', 'varanasi', 'patna', 'gonda', 'basti') as east
  from usable u join fleet f on u.vehicle_reg = f.reg_canon left join people p on u.driver_id = p.driver_id
)"""

# Every asked (vehicle, day) and its facts: own vehicles and pool vehicles.
VEHICLE_DAYS = """
asked as (
  select distinct vehicle_reg as reg_canon, day, false as in_pool from admitted
  union all
  select f.reg_canon, d.day, true from fleet f join (select distinct origin_hub, day from admitted) d on f.home_hub = d.origin_hub
),
h_all as (select reg_canon, day as last_service from history group by all),
h_brake as (select reg_canon, day as last_brake from history where is_brake group by all),
h_fix as (select reg_canon, day as last_fix from history where is_temp_fix group by all),
vdays as (
  select a.reg_canon, a.day, a.in_pool, f.home_hub, f.bs_stage, f.year, f.heater,
    datediff('day', h1.last_service, a.day) - 90 as past_service,
    coalesce(datediff('day', h2.last_brake, a.day), 99999) as brake_days,
    coalesce(datediff('day', h3.last_fix, a.day) <= 7, false) as temp_fix,
    h1.last_service, h2.last_brake, h3.last_fix
  from asked a join fleet f on a.reg_canon = f.reg_canon
  asof left join h_all h1 on a.reg_canon = h1.reg_canon and a.day >= h1.last_service
  asof left join h_brake h2 on a.reg_canon = h2.reg_canon and a.day >= h2.last_brake
  asof left join h_fix h3 on a.reg_canon = h3.reg_canon and a.day >= h3.last_fix
)"""

# One letter per exclusion rule, in rule order: bs4-winter, hill-brake, hill-heater, temp-fix, service, newest.
LETTERS = [
    ("R-BS4-NCR-WINTER", "case when t.mon in (10, 11, 12, 1, 2) and t.ncr and v.bs_stage = 'BS4' then 'T' else 'F' end",
     "No BS4 on a capital-region route from October to February", None),
    ("R-HILL-BRAKE-30", "case when t.hill and v.brake_days < 30 then 'T' else 'F' end",
     "No hill run within thirty days of brake work", None),
    ("R-HILL-HEATER", "case when v.heater is null then 'M' when t.mon in (11, 12, 1, 2) and t.hill and not v.heater then 'T' else 'F' end",
     "A winter hill run needs an engine heater", "'vehicle_has_heater'"),
    ("R-JUGAAD-7DAY", "case when v.temp_fix then 'T' else 'F' end", "A temporary fix is a seven day clock", None),
    ("R-SERVICE-OVERDUE-30", "case when v.past_service is null then 'M' when v.past_service > 30 then 'T' else 'F' end",
     "More than thirty days past due means grounded", "'vehicle_days_past_service'"),
    ("R-ORION-NEWEST", "case when t.client is null then 'M' when t.client = 'orion_pharma' and v.year < 2020 then 'T' else 'F' end",
     "Only vehicles from 2020 on", "'client_is'"),
]
_LETTER_COLUMNS = ", ".join(f"{sql} as r{i}" for i, (_, sql, _, _) in enumerate(LETTERS))
_BLOCKED = " or ".join(f"r{i} <> 'F'" for i in range(len(LETTERS)))
_COUNTS = ", ".join(f"count_if(r{i} = 'T') as f{i}, count_if(r{i} = 'M') as u{i}" for i in range(len(LETTERS)))

PAIRS = f"""
pairs as (
  select *, ({_BLOCKED}) as blocked, r0 || r1 || r2 || r3 || r4 || r5 as outcome from (
    select t.ticket_id, t.client, v.reg_canon as cid, v.year, {_LETTER_COLUMNS}
    from admitted t join vdays v on v.home_hub = t.origin_hub and v.day = t.day and v.in_pool and v.reg_canon <> t.vehicle_reg
  )
),
chosen as (
  select ticket_id, cid as replacement, year as replacement_year from pairs where not blocked
  qualify row_number() over (partition by ticket_id order by case when client = 'orion_pharma' then -year else 0 end, cid) = 1
),
refused as (
  select ticket_id, string_agg(cid || '=' || outcome, ',' order by cid) as rejected from (
    select * from pairs where blocked qualify row_number() over (partition by ticket_id order by cid) <= 8
  ) group by 1
),
pair_counts as (
  select ticket_id, count(*) as n_considered, count_if(not blocked) as n_eligible, {_COUNTS} from pairs group by 1
),
selected as (
  select t.*, c.replacement, c.replacement_year, coalesce(n_considered, 0) as n_considered, coalesce(n_eligible, 0) as n_eligible,
    coalesce(r.rejected, '') as rejected,
    {', '.join(f"coalesce(f{i}, 0) as f{i}, coalesce(u{i}, 0) as u{i}" for i in range(len(LETTERS)))}
  from admitted t left join chosen c using (ticket_id) left join refused r using (ticket_id) left join pair_counts using (ticket_id)
)"""

_by_label = sorted(
    [(f"{rid}", f"f{i}") for i, (rid, *_) in enumerate(LETTERS)]
    + [(f"{rid}(no data)", f"u{i}") for i, (rid, *_) in enumerate(LETTERS)]
)
BLOCKS_COUNTED = "concat_ws(', ', " + ", ".join(f"case when {c} > 0 then '{n} x' || {c} end" for n, c in _by_label) + ")"
BLOCKS_NAMED = "concat_ws(', ', " + ", ".join(f"case when {c} > 0 then '{n}' end" for n, c in _by_label) + ")"


def with_(*parts: str) -> str:
    """A WITH clause out of the parts, which must come in order of use."""
    return "with " + ",".join(p.strip() for p in parts) + "\n"


RUN = (TICKETS, FLEET, HISTORY, PEOPLE, ADMITTED, VEHICLE_DAYS, PAIRS)

"""Queries over whole queue runs: what is stored and exported, also after a second run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.plans import domain as D
from adjudica.plans import oracle as O
from adjudica.plans import run
from adjudica.plans.queries_sources import RENAMED, spread_texts
from adjudica.plans.registry import query
from adjudica.session import scratch_path

RUN = O.with_(*O.RUN)
UP_TO_ADMITTED = O.with_(O.TICKETS, O.FLEET, O.PEOPLE, O.ADMITTED)


def _exported(spark: SparkSession, sf: str, name: str, runs: int = 1) -> DataFrame:
    root, out = scratch_path(spark, "queue-run"), scratch_path(spark, "exports")
    for k in range(runs):
        run.run_queue(D.inputs(spark, sf), root, f"b{k}", D.SALT)
    run.export_run(spark, root, out, [name])
    return spark.read.text(f"{out}/{name}").select(F.try_parse_json("value").alias("v"))


def _text(field: str):  # noqa: ANN202
    return F.try_variant_get("v", f"$.{field}", "string").alias(field)


@query("export_work_orders", RUN + """
    select 'WO-' || substr(sha256(ticket_id), 1, 32) as work_order_id, ticket_id, vehicle_reg,
      strftime(ats - interval 330 minute, '%Y-%m-%dT%H:%M:%S') || '.000Z' as created_at from selected
""")
def export_work_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The queue runs twice; the second run adds nothing."""
    return _exported(spark, sf, "work_orders", 2).select(*[_text(f) for f in ("work_order_id", "ticket_id", "vehicle_reg", "created_at")])


@query("export_comms_pending", RUN + "select 'MSG-' || substr(sha256(ticket_id), 1, 32) as message_id, ticket_id, client as recipient from selected")
def export_comms_pending(spark: SparkSession, sf: str) -> DataFrame:
    return _exported(spark, sf, "comms_pending").select(*[_text(f) for f in ("message_id", "ticket_id", "recipient")])


_APPROVED = O.with_(*O.RUN, """
approvals as (select 'TKT-' || (event_id * 3 // 2 - event_id % 2) as ticket_id, case when event_type = 'error' then null else 'user' || user_id end as who, ts as at_ts,
  event_id % 2 as half from events),
usable_approvals as (select a.ticket_id, half, strftime(at_ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' as at_text, who from approvals a join selected using (ticket_id) where who is not null),
first_half as (select ticket_id, min(half) as half from usable_approvals group by 1),
sent as (select ticket_id, min((at_text, who)) as a from usable_approvals join first_half using (ticket_id, half) group by 1)""")


@query("export_comms_sent", _APPROVED + "select 'MSG-' || substr(sha256(ticket_id), 1, 32) as message_id, ticket_id, a[2] as approved_by, a[1] as sent_at from sent")
def export_comms_sent(spark: SparkSession, sf: str) -> DataFrame:
    """Approvals come in two calls, the second one repeated; what the first call sent stays as it was, export after export."""
    root, out = scratch_path(spark, "queue-run"), scratch_path(spark, "exports")
    run.run_queue(D.inputs(spark, sf), root, "b0", D.SALT)
    asked = D.table(spark, sf, "events").selectExpr(
        "concat('TKT-', event_id * 3 div 2 - event_id % 2) as ticket_id", "case when event_type = 'error' then ' ' else concat('user', user_id) end as approver",
        "cast(ts as timestamp) as at", "event_id % 2 as half",
    )
    for label, half in (("a0", 0), ("a1", 1), ("a1", 1)):
        run.approve(spark, root, asked.where(F.col("half") == half).drop("half"), label)
    for _ in range(2):
        run.export_run(spark, root, out, ["comms_sent"])
    rows = spark.read.text(f"{out}/comms_sent").select(F.try_parse_json("value").alias("v"))
    return rows.select(*[_text(f) for f in ("message_id", "ticket_id", "approved_by", "sent_at")])


@query("export_quarantine", UP_TO_ADMITTED + """
    , reasons as (select ticket_id, ats, unnest(list_filter([case when ticket_id is null then 'missing_ticket_id' end,
      case when vehicle_reg is null then 'missing_vehicle' end, case when origin_hub is null then 'missing_origin_hub' end,
      case when ats is null then 'unparseable_created_at' end], lambda x: x is not null)) as reason from first_t
    union all select ticket_id, ats, 'vehicle_not_in_fleet' from usable where vehicle_reg not in (select reg_canon from fleet))
    select coalesce(ticket_id, 'MALFORMED') as ticket_key, reason, strftime(ats - interval 330 minute, '%Y-%m-%dT%H:%M:%S') || '.000Z' as detected_at,
      'queue' as source_file, true as has_raw from reasons
""")
def export_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    rows = _exported(spark, sf, "quarantine")
    key = F.regexp_replace(_text("ticket_key"), "^(MALFORMED):Q-[0-9a-f]{32}$", "$1").alias("ticket_key")
    return rows.select(key, _text("reason"), _text("detected_at"), _text("source_file"), F.try_variant_get("v", "$.raw.status", "string").isNotNull().alias("has_raw"))


@query("export_audit", UP_TO_ADMITTED + """
    select ticket_id, step, case step when 'dedupe' then n || ' further copies left out, the first one counts' end as decision from (
      select ticket_id, 'dedupe' as step, count(*) - 1 as n from tickets where ticket_id is not null group by 1 having count(*) > 1
      union all select coalesce(ticket_id, 'MALFORMED'), 'validate', 0 from first_t where ticket_id is null or vehicle_reg is null or origin_hub is null or ats is null
      union all select ticket_id, 'enrich', 0 from usable
      union all select ticket_id, unnest(['classify', 'select_source_hub', 'select_vehicle', 'work_order', 'comms']), 0 from admitted)
""")
def export_audit(spark: SparkSession, sf: str) -> DataFrame:
    """Every record leaves its lines: decided ones, copies, unusable ones and those without a vehicle."""
    always = ["dedupe", "validate", "enrich", "classify", "select_source_hub", "select_vehicle", "work_order", "comms"]
    rows = _exported(spark, sf, "audit").select(_text("ticket_id"), _text("step"), _text("decision"))
    key = F.regexp_replace("ticket_id", "^(MALFORMED):Q-[0-9a-f]{32}$", "$1").alias("ticket_id")
    return rows.where(F.col("step").isin(always)).select(key, "step", F.when(F.col("step") == "dedupe", F.col("decision")).alias("decision"))


def _queue_files(spark: SparkSession, sf: str) -> str:
    """The whole queue as twenty files: arrays with a bare number each, wrapped arrays, and lines; copies of a record follow it."""
    path = scratch_path(spark, "queue-files")
    record = F.to_json(F.struct(*[F.col(k).alias(v) for k, v in RENAMED.items()]), {"ignoreNullFields": "false"})
    one = D.raw_tickets(spark, sf).select((F.expr("pos div 2") % 20).alias("k"), "pos", record.alias("r"))
    kind = F.col("k") % 3
    before = F.when(kind == 0, "[").when(kind == 1, '{"rows": [')
    after = F.when(kind == 0, F.concat(F.lit(", "), F.col("k").cast("string"), F.lit("]"))).when(kind == 1, "]}")
    text = spread_texts(one, F.when(kind == 2, "\n").otherwise(","), before, after)
    text.select("k", "value").write.partitionBy("k").option("lineSep", " ").text(path)
    return f"{path}/*/*.txt"


@query("run_files", O.with_(*O.RUN, """
    reasons as (select ticket_id, unnest(list_filter([case when ticket_id is null then 'missing_ticket_id' end,
      case when vehicle_reg is null then 'missing_vehicle' end, case when origin_hub is null then 'missing_origin_hub' end,
      case when ats is null then 'unparseable_created_at' end], lambda x: x is not null)) as reason from first_t
    union all select ticket_id, 'vehicle_not_in_fleet' from usable where vehicle_reg not in (select reg_canon from fleet)
    union all select null, 'record_not_an_object' from (select distinct pos // 2 % 20 as f from tickets) where f % 3 = 0)""") + """
    select 'work_orders' as kind, ticket_id as key, origin_hub as detail from selected
    union all select 'comms', ticket_id, client from selected
    union all select 'quarantine', coalesce(ticket_id, 'MALFORMED'), reason from reasons
    union all select 'replayed', '', cast(count(*) as varchar) from selected
""")
def run_files(spark: SparkSession, sf: str) -> DataFrame:
    """From files of every shape to stored tables; the second run of the same files adds nothing and says so."""
    root, path = scratch_path(spark, "queue-run"), _queue_files(spark, sf)
    given = D.inputs(spark, sf)
    for label in ("b0", "b1"):
        summary = run.run_files(spark, path, given.fleet, given.history, given.people, root, label, D.SALT)
    orders, messages, held = (run.stored(spark, root, n) for n in ("work_orders", "comms", "quarantine"))
    rows = [
        orders.select(F.lit("work_orders").alias("kind"), F.col("ticket_id").alias("key"), F.col("origin_hub").alias("detail")),
        messages.select(F.lit("comms"), "ticket_id", "recipient"),
        held.select(F.lit("quarantine"), F.regexp_replace("ticket_key", "^(MALFORMED):Q-[0-9a-f]{32}$", "$1"), "reason"),
        summary.where("outcome = 'replayed'").select("outcome", F.lit(""), F.col("n").cast("string")),
    ]
    return rows[0].unionAll(rows[1]).unionAll(rows[2]).unionAll(rows[3])

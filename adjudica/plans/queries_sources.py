"""Queries that write files derived from the tables and read them back: scans, queues, sinks, streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adjudica.functions import temporal as T
from adjudica.functions.identity import content_id
from adjudica.operators import checks, dedupe, validate
from adjudica.operators.outbox import read_state
from adjudica.plans import domain as D
from adjudica.plans import oracle as O
from adjudica.plans.registry import query
from adjudica.session import scratch_path, stage
from adjudica.sources import context, files, queue
from adjudica.streaming import incremental

ROSTER = ["customer", "segment", "remark"]


def _roster_csv(spark: SparkSession, sf: str) -> str:
    """Customers as CSV with quotes and commas inside fields, one header per file; every other file has another order."""
    path = scratch_path(spark, "csv")
    rows = D.table(spark, sf, "customer").selectExpr(
        "cast(c_custkey as string) as customer", "c_mktsegment as segment",
        "case when c_custkey % 3 = 0 then concat('said \"no\", then ', c_name) when c_custkey % 3 = 1 then '' else c_name end as remark",
        "c_custkey",
    )
    for odd, names in ((0, ["customer", "segment", "remark"]), (1, ["remark", " Customer", "SEGMENT"])):
        part = rows.where(F.col("c_custkey") % 2 == odd).repartitionByRange(3, "c_custkey").sortWithinPartitions("c_custkey")
        part = part.select(*[F.col(n.strip().lower()).alias(n) for n in names])
        part.write.mode("append").option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return path


_REMARK = "case when c_custkey % 3 = 0 then 'said \"no\", then ' || c_name when c_custkey % 3 = 1 then '' else c_name end"


@query("scan_csv", f"select cast(c_custkey as varchar) as customer, c_mktsegment as segment, {_REMARK} as remark from customer")
def scan_csv(spark: SparkSession, sf: str) -> DataFrame:
    return files.scan_csv(spark, _roster_csv(spark, sf), ROSTER)


@query("with_lineage", "select count(*) as n_rows, count(*) as n_distinct, true as in_order, true as from_two from customer")
def with_lineage(spark: SparkSession, sf: str) -> DataFrame:
    df = files.scan_csv(spark, _roster_csv(spark, sf), ROSTER, lineage=True)
    # Within a file the keys were written in order, so row number and key must rise together.
    ranked = df.select("source_file", "source_row", F.col("customer").cast("long").alias("k"))
    before = F.lag("k").over(Window.partitionBy("source_file").orderBy("source_row"))
    per_file = ranked.withColumn("rises", F.coalesce(F.col("k") > before, F.lit(True))).groupBy("source_file").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("source_row").alias("d"), F.min("source_row").alias("first"),
        F.max("source_row").alias("last"), F.bool_and("rises").alias("c"),
    )
    return per_file.agg(
        F.sum("n").alias("n_rows"), F.sum("d").alias("n_distinct"), F.bool_and("c").alias("in_order"),
        F.bool_and((F.col("first") == 2) & (F.col("last") == F.col("n") + 1)).alias("from_two"),
    )


@query("require_columns", "select count(*) as n_rows from customer where c_mktsegment <> ''")
def require_columns(spark: SparkSession, sf: str) -> DataFrame:
    path = _roster_csv(spark, sf)
    try:
        files.require_columns(files.scan_csv(spark, path, [*ROSTER, "phone"]), [*ROSTER, "phone"], "roster")
    except files.GateError:
        df = files.require_columns(files.scan_csv(spark, path, ROSTER), ROSTER, "roster")
    else:
        raise AssertionError("a file without the column was let through")
    return df.filter("segment <> ''").agg(F.count(F.lit(1)).alias("n_rows"))


@query("gate_nonempty", "select 'orders' as table_name, count(*) as n_rows from orders union all select 'supplier', count(*) from supplier")
def gate_nonempty(spark: SparkSession, sf: str) -> DataFrame:
    from adjudica.operators.lookup import table_counts

    tables = {n: D.table(spark, sf, n) for n in ("orders", "supplier")}
    files.gate_nonempty(tables)
    return table_counts(tables)


_MAIL = "'From: ops' || chr(10) || 'Date: ' || strftime(o_orderdate + interval 20 year, '%a, %d %b %Y') || ' 10:30 +0530' || chr(10) || chr(10) || 'Order ' || o_orderkey"


def _mails(spark: SparkSession, sf: str) -> DataFrame:
    return D.table(spark, sf, "orders").selectExpr(
        "concat('emails/', o_orderkey, '.txt') as path", "o_orderkey",
        """concat('From: ops\\n', case when o_orderkey % 10 = 0 then '' else concat('Date: ', date_format(o_orderdate + interval 20 year, 'EEE, dd MMM yyyy'), ' 10:30 +0530\\n') end,
           '\\nOrder ', o_orderkey, ' call 98', lpad(cast(o_orderkey % 100000000 as string), 8, '0')) as text""",
    )


@query("extract_header", "select o_orderkey, case when o_orderkey % 10 <> 0 then strftime(o_orderdate + interval 20 year, '%a, %d %b %Y') || ' 10:30 +0530' end as header from orders")
def extract_header(spark: SparkSession, sf: str) -> DataFrame:
    return _mails(spark, sf).select("o_orderkey", context.extract_header("text").alias("header"))


_PHONE = O.token("PHONE", "'98' || lpad(cast(o_orderkey % 100000000 as varchar), 8, '0')")


@query("load_documents", f"""
    select 'doc:emails/' || o_orderkey || '.txt' as fact_id, 'email_thread' as fact_type,
      case when o_orderkey % 10 <> 0 then strftime(o_orderdate + interval 20 year, '%Y-%m-%d') || 'T05:00:00.000Z' end as observed_at,
      'Order ' || o_orderkey || ' call ' || {_PHONE} as last_line from orders
""")
def load_documents(spark: SparkSession, sf: str) -> DataFrame:
    facts = context.load_documents(_mails(spark, sf), D.SALT)
    return facts.select(
        "fact_id", "fact_type", T.utc_text("observed_at").alias("observed_at"),
        F.element_at(F.split("value.text", "\n"), -1).alias("last_line"),
    )


@query("scan_documents", "select doc_id // 10 as k, count(*) as n_lines, cast(sum(length(coalesce(text, ''))) as bigint) as n_chars from documents group by 1")
def scan_documents(spark: SparkSession, sf: str) -> DataFrame:
    """One text file for ten documents: its number, then a line for each document with its line breaks as blanks."""
    path = scratch_path(spark, "texts")
    one = D.table(spark, sf, "documents").select(F.expr("doc_id div 10").alias("k"), F.regexp_replace(F.coalesce("text", F.lit("")), r"[\r\n]", " ").alias("t"))
    whole = one.groupBy("k").agg(F.concat_ws("\n", F.col("k").cast("string"), F.collect_list("t")).alias("value"))
    # A row per file in one folder, each moved there by its task: a folder for every file would be made, moved and listed by the driver.
    one_each = whole.select("value").write.option("maxRecordsPerFile", 1)
    one_each.option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
    line = F.split("text", "\n")
    docs = files.scan_documents(spark, path).withColumn("lines", F.slice(line, 2, F.size(line)))
    # The writer ends a text with a line break, after which nothing follows.
    size = F.aggregate(F.transform("lines", F.length), F.lit(0).cast("bigint"), lambda a, b: a + b)
    return docs.select(line[0].cast("long").alias("k"), (F.size("lines") - 1).cast("long").alias("n_lines"), size.alias("n_chars"))


RENAMED = {
    "ticket_id": "Ticket No", "created_at": "opened-at", "vehicle": "truck", "driver_id": "driver_id", "origin_hub": "From Hub",
    "destination": "destination", "km_from_origin_hub": "distance.km", "issue": "fault", "severity": "priority", "client": "customer",
    "status": "status", "resolution_note": "remarks",
}


@query("scan_queue", O.with_(O.TICKETS) + """
    select 'ndjson' as shape, count(*) as n, count(*) as n_objects from tickets
""")
def scan_queue(spark: SparkSession, sf: str) -> DataFrame:
    records = queue.scan_queue(spark, f"{_line_queue(spark, sf)}/*.txt")
    return records.groupBy("shape").agg(F.count(F.lit(1)).alias("n"), F.count("record").alias("n_objects"))


def _line_queue(spark: SparkSession, sf: str) -> str:
    """The whole queue, copies included, as JSON lines with renamed and nested fields."""
    path = scratch_path(spark, "lines")
    about = F.struct(F.col("vehicle").alias("truck"), F.col("client").alias("customer"), F.lit("inner").alias("status"))
    outer = [F.col(k).alias(v) for k, v in RENAMED.items() if k not in ("vehicle", "client")]
    record = F.struct(*outer, about.alias("about"), F.col("pos").cast("string").alias("pos"))
    D.raw_tickets(spark, sf).select(F.to_json(record, {"ignoreNullFields": "false"}).alias("value")).write.text(path)
    return path


_FILES = 20


def _document_queue(spark: SparkSession, sf: str) -> str:
    """The whole queue in files of every shape: arrays, wrapped arrays, lines, single objects, cut arrays, an empty file.

    Planted are records that repeat a key, in every array and line file, and a bare number in every array.
    """
    path = scratch_path(spark, "docs")
    record = F.to_json(F.struct(*[F.col(k).alias(v) for k, v in RENAMED.items()]), {"ignoreNullFields": "false"})
    lines = D.raw_tickets(spark, sf).select((F.col("pos") % _FILES).alias("k"), "pos", record.alias("r"))
    odd = '{"Ticket No": "first", "Ticket No": "last", "truck": "t"}'
    k = F.col("k") % 5
    before = F.when(k == 0, f"[{odd}, 7, ").when(k == 1, '{"rows": [').when(k == 3, "[")
    after = F.when(k == 0, "]").when(k == 1, f", {odd}]}}").when(k == 2, f"\n{odd}\n")
    void = spark.range(1).select(F.lit(_FILES).cast("long").alias("k"), F.lit(" ").alias("value"))
    text = spread_texts(lines, F.when(k == 2, "\n").when(k == 4, "").otherwise(","), before, after)
    text = text.filter((k != 4) | F.col("first")).select("k", "value")
    for part in (text, void):
        part.write.mode("append").partitionBy("k").option("lineSep", " ").text(path)
    return path


def spread_texts(parts: DataFrame, between: Column, before: Column, after: Column) -> DataFrame:
    """``parts`` (k, pos, r) as the rows of one text per ``k``, in the order of ``pos``: its ``value``, and whether it is the ``first``.

    A text is written row after row and never held as one value. A blank as the writer's line separator keeps it on a line.
    """
    w = Window.partitionBy("k").orderBy("pos")
    placed = parts.withColumns({"first": F.row_number().over(w) == 1, "last": F.lead("pos").over(w).isNull()})
    value = F.concat(
        F.coalesce(F.when(F.col("first"), before), F.lit("")), "r", F.when(F.col("last"), F.coalesce(after, F.lit(""))).otherwise(between)
    )
    return placed.select("k", "pos", "first", value.alias("value")).sortWithinPartitions("k", "pos")


_SHAPES = O.with_(O.TICKETS, f"""
    files as (select pos % {_FILES} % 5 as kind, count(*) as n, count(distinct pos % {_FILES}) as f from tickets group by 1),
    shapes as (
      select case kind when 0 then 'json_array' when 1 then 'json_object.rows' when 2 then 'ndjson' when 3 then 'unrecognised' else 'json_single_object' end as shape,
        case kind when 0 then n + 2 * f when 1 then n + f when 2 then n + f else f end as n, case kind when 0 then n + f when 1 then n + f when 2 then n + f when 3 then 0 else f end as n_objects from files
      union all select 'empty', 1, 0)""")


@query("scan_queue_documents", _SHAPES + " select shape, n, n_objects from shapes")
def scan_queue_documents(spark: SparkSession, sf: str) -> DataFrame:
    records = queue.scan_queue(spark, f"{_document_queue(spark, sf)}/*/*.txt")
    return records.groupBy("shape").agg(F.count(F.lit(1)).alias("n"), F.count("record").alias("n_objects"))


@query("scan_queue_records", O.with_(O.TICKETS) + f"""
    select ticket_id, count(*) as n from (select ticket_id from tickets where pos % {_FILES} % 5 < 3
      union all select 'LAST' from (select distinct pos % {_FILES} as k from tickets) where k % 5 < 3) group by 1
""")
def scan_queue_records(spark: SparkSession, sf: str) -> DataFrame:
    """Every record of the arrays, wrapped arrays and line files, by its id; of a repeated key the last value counts."""
    usable, _ = queue.split_unusable(queue.scan_queue(spark, f"{_document_queue(spark, sf)}/*/*.txt"))
    listed = usable.filter("shape <> 'json_single_object'").select(F.upper(F.trim(F.try_variant_get("record", "$['Ticket No']", "string"))).alias("ticket_id"))
    return listed.groupBy("ticket_id").agg(F.count(F.lit(1)).alias("n"))


@query("split_unusable", _SHAPES + " select 'usable' as kind, cast(sum(n_objects) as bigint) as n from shapes union all select 'unusable', cast(sum(n - n_objects) as bigint) from shapes")
def split_unusable(spark: SparkSession, sf: str) -> DataFrame:
    good, bad = queue.split_unusable(queue.scan_queue(spark, f"{_document_queue(spark, sf)}/*/*.txt"))
    count = F.count(F.lit(1)).alias("n")
    return good.agg(count).select(F.lit("usable").alias("kind"), "n").unionByName(bad.agg(count).select(F.lit("unusable").alias("kind"), "n"))


@query("gate_fatal", _SHAPES + " select cast(sum(n) as bigint) as n_bad from shapes where shape in ('empty', 'unrecognised')")
def gate_fatal(spark: SparkSession, sf: str) -> DataFrame:
    records = stage(queue.scan_queue(spark, f"{_document_queue(spark, sf)}/*/*.txt").select("source_file", "shape"), "shapes")
    try:
        queue.gate_fatal(records)
    except files.GateError:
        return records.filter("shape in ('empty', 'unrecognised')").agg(F.count(F.lit(1)).alias("n_bad"))
    raise AssertionError("the gate let a broken queue through")


def _flat(spark: SparkSession, sf: str) -> DataFrame:
    usable, _ = queue.split_unusable(queue.scan_queue(spark, f"{_line_queue(spark, sf)}/*.txt"))
    return usable.withColumn("fields", queue.flatten_once("record"))


@query("flatten_once", O.with_(O.TICKETS) + "select pos, 13 as n_fields, lower(status) as status from tickets")
def flatten_once(spark: SparkSession, sf: str) -> DataFrame:
    text = lambda name: F.try_element_at("fields", F.lit(name)).cast("string")
    return _flat(spark, sf).select(text("pos").cast("long").alias("pos"), F.size("fields").alias("n_fields"), text("status").alias("status"))


@query("adapt_columns", O.with_(O.TICKETS) + """
    select pos, ticket_id, vehicle_reg, client, origin_hub, dest_hub, km, issue, severity, strftime(ats, '%Y-%m-%d %H:%M') as at from tickets
""")
def adapt_columns(spark: SparkSession, sf: str) -> DataFrame:
    adapted = queue.adapt_columns(_flat(spark, sf), "fields").drop("pos").withColumn(
        "pos", F.try_element_at("fields", F.lit("pos")).cast("string").cast("long")
    )
    t = D.ticket_rows(adapted)
    return t.select(
        "pos", "ticket_id", "vehicle_reg", "client", "origin_hub", "dest_hub", F.col("km_from_origin").alias("km"), "issue",
        F.col("severity_reported").alias("severity"), F.date_format(T.wall_clock("created_at"), "yyyy-MM-dd HH:mm").alias("at"),
    )


@query("gate_recognised", O.with_(O.TICKETS) + """
    select unnest(['ticket_id', 'created_at', 'vehicle', 'driver_id', 'origin_hub', 'destination', 'km_from_origin_hub', 'issue', 'severity', 'client', 'status', 'resolution_note']) as field,
      n as n_found from (select count(*) as n from tickets)
""")
def gate_recognised(spark: SparkSession, sf: str) -> DataFrame:
    matched = queue.matched_fields(_flat(spark, sf), "fields")
    queue.gate_recognised(matched)
    return matched.select("field", "n_found")


@query("renamed_fields", O.with_(O.TICKETS) + """
    select unnest(['ticket_id', 'created_at', 'vehicle', 'origin_hub', 'km_from_origin_hub', 'issue', 'severity', 'client', 'resolution_note']) as field,
      n as n_found from (select count(*) as n from tickets)
""")
def renamed_fields(spark: SparkSession, sf: str) -> DataFrame:
    return queue.renamed_fields(queue.matched_fields(_flat(spark, sf), "fields"))


@query("canonical_key", "select p_partkey, regexp_replace(lower(p_name || '-' || p_brand || '.' || p_type), '[\\s_\\-.]', '', 'g') as k from part")
def canonical_key(spark: SparkSession, sf: str) -> DataFrame:
    name = F.concat_ws(".", F.concat_ws("-", "p_name", "p_brand"), "p_type")
    return D.table(spark, sf, "part").select("p_partkey", queue.canonical_key(name).alias("k"))


@query("sink_jsonl_sorted", """
    select '{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","note":' || case when c_custkey % 2 = 0 then 'null' else '"odd"' end || '}' as value from customer
""")
def sink_jsonl_sorted(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "jsonl")
    rows = D.table(spark, sf, "customer").withColumn("note", F.when(F.col("c_custkey") % 2 == 1, "odd"))
    context.sink_jsonl_sorted(rows, path, ["c_custkey"], ["c_custkey", "c_name", "note"])
    return spark.read.text(path)


@query("publish_context", "select c_custkey, c_name from customer")
def publish_context(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "context")
    people = D.table(spark, sf, "customer").select("c_custkey", "c_name")
    # Ten publications; the names of the last two sort the wrong way round.
    for k in range(1, 10):
        context.publish_context({"people": people.withColumn("c_name", F.concat(F.lit(f"{k} "), "c_name"))}, root, f"v{k}")
    context.publish_context({"people": people}, root, "v10")
    return context.read_context(spark, root, "people")


# --- streams -----------------------------------------------------------------------------------------------

_STATE = {
    "orders": (["ticket_id"], ["id"], "id string, ticket_id string"),
    "quarantine": (["ticket_key", "reason"], ["ticket_key"], "ticket_key string, reason string"),
}


def queue_job(batch: DataFrame) -> dict[str, DataFrame]:
    """One micro-batch of raw queue records: orders for usable ones, quarantine rows for the rest."""
    rows = D.ticket_rows(batch).select("ticket_id", "created_at", "vehicle_reg", "origin_hub", "pos", "raw_json")
    # Parsed and ranked once: orders and quarantine both read it.
    first = stage(validate.validate(dedupe.dedupe_first(rows, ["ticket_id"], ["pos"])), "judged")
    orders = first.filter(F.size("reasons") == 0).select(content_id("WO", "ticket_id").alias("id"), "ticket_id")
    return {"orders": orders, "quarantine": validate.quarantine_rows(first, "ticket_id", "raw_json", D.SALT).drop("raw_json")}


@query("run_incremental", O.with_(O.TICKETS, O.FLEET, O.PEOPLE, O.ADMITTED) + """
    select 'WO-' || substr(sha256(ticket_id), 1, 32) as id, ticket_id from usable
""")
def run_incremental(spark: SparkSession, sf: str) -> DataFrame:
    landing, root, checkpoint = (scratch_path(spark, x) for x in ("landing", "state", "progress"))
    raw = D.raw_tickets(spark, sf)
    # Files arrive together and are drained in two batches, four files at least; copies of a record land in one file.
    half = max(2, -(-spark.sparkContext.defaultParallelism // 2))
    raw.withColumn("k", F.expr("pos div 2")).repartition(2 * half, "k").drop("k").write.parquet(landing)
    schema = raw.schema.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ")
    for _ in range(2):
        stream = incremental.read_folder(spark, landing, schema, per_batch=half)
        incremental.run_incremental(stream, queue_job, root, checkpoint, _STATE)
    return read_state(spark, root, "orders", _STATE["orders"][2])


@query("distinct_events", "select event_id, user_id, event_type from events")
def distinct_events(spark: SparkSession, sf: str) -> DataFrame:
    landing, root, checkpoint = (scratch_path(spark, x) for x in ("landing", "distinct", "progress"))
    events = D.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type")
    # Eight files, two to a batch: most second copies come batches later, and old events after new ones.
    events.unionByName(events).repartition(8).write.parquet(landing)
    stream = incremental.read_folder(spark, landing, "event_id long, ts timestamp, user_id long, event_type string", per_batch=2)
    once = incremental.distinct_events(stream, ["event_id"], ["ts", "user_id"], root, checkpoint)
    return once.select("event_id", "user_id", "event_type")


@query("check_replay_run", "select count(*) as n_first, count(*) as n_second, true as same from (select distinct o_orderkey from orders where o_orderkey % 101 <> 7)")
def check_replay_run(spark: SparkSession, sf: str) -> DataFrame:
    """Deduplicating the queue in two different row orders gives the same content."""
    # Parsed once; the second row order is a shuffle of what was written.
    t = stage(D.tickets(spark, sf).drop("raw_json").filter("ticket_id is not null"), "tickets")
    again = t.repartition(max(5, spark.sparkContext.defaultParallelism), "driver_id").sortWithinPartitions(F.col("pos").desc())
    return checks.check_replay(*[dedupe.dedupe_first(x, ["ticket_id"], ["pos"]) for x in (t, again)])

"""A queue run from canonical inputs to stored tables and exports: each key is written once, however often it runs."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.functions import privacy as P
from adjudica.functions import temporal as T
from adjudica.functions.identity import content_id
from adjudica.operators import assemble, dedupe, outbox, select, validate
from adjudica.plans import decision, domain
from adjudica.rulebook import DEFAULT_RULES, Rule
from adjudica.session import stage
from adjudica.sources import queue
from adjudica.sources.context import sink_jsonl_sorted

LEAK = "unexpected_error: personal data in the message"

# Stored tables with their key and what orders rows of one key.
TABLES = {
    "work_orders": (["ticket_id"], ["work_order_id"]),
    "comms": (["ticket_id"], ["message_id"]),
    "quarantine": (["ticket_key", "reason"], ["raw_json"]),
    "audit": (["ticket_id", "step"], ["decision"]),
}

KEYS = {name: keys for name, (keys, _) in TABLES.items()} | {"sent": ["ticket_id"], "approval_log": ["approval_id"]}
APPROVED = "ticket_id string, approved_by string, sent_at string"

# Exports: the table, a filter, the fields in order.
EXPORTS = {
    "work_orders": ("work_orders", "true", ["work_order_id", "ticket_id", "vehicle_reg", "created_at", "citations"]),
    "comms_pending": ("comms", "status = 'pending'", ["message_id", "ticket_id", "recipient", "body", "context", "citations"]),
    "comms_sent": ("comms", "status = 'sent'", ["message_id", "ticket_id", "recipient", "body", "approved_by", "sent_at"]),
    "quarantine": ("quarantine", "true", ["ticket_key", "reason", "source_file", "detected_at", "raw"]),
    "audit": ("audit", "true", ["ticket_id", "step", "decision", "data_used", "rule_id", "actor", "at"]),
}


def _schema(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def quarantined(done: decision.Decision, salt: str, source_file: str) -> DataFrame:
    """Quarantine rows of unusable records and of those whose vehicle is unknown."""
    unknown = done.orphans.withColumn("reasons", F.array(F.lit(validate.NOT_IN_FLEET)))
    parts = [
        df.select("ticket_id", "raw_json", "reasons", F.lit(source_file).alias("source_file"), F.col("created_at").alias("detected_at"))
        for df in (done.invalid, unknown)
    ]
    return validate.quarantine_rows(parts[0].unionByName(parts[1]), "ticket_id", "raw_json", salt, ["source_file", "detected_at"])


def leaking(messages: DataFrame, patterns: Sequence[P.Pattern] = P.DEFAULT_PATTERNS) -> DataFrame:
    """Keys of drafted messages whose body, context or citations hold personal data."""
    text = F.concat_ws(" ", "body", F.to_json("context"), F.to_json("citations"))
    return messages.where(P.has_pii(text, patterns)).select("ticket_id")


def _isolated(tickets: DataFrame, keys: DataFrame, salt: str, source_file: str) -> DataFrame:
    """Quarantine rows, masked, of records that failed at the gate."""
    rows = dedupe.dedupe_first(tickets.join(keys, "ticket_id", "left_semi"), ["ticket_id"], ["pos"])
    rows = rows.select(
        "ticket_id", "raw_json", F.array(F.lit(LEAK)).alias("reasons"), F.lit(source_file).alias("source_file"), F.col("created_at").alias("detected_at")
    )
    return validate.quarantine_rows(rows, "ticket_id", "raw_json", salt, ["source_file", "detected_at"])


def audited(done: decision.Decision, rules: Sequence[Rule], source_file: str) -> DataFrame:
    """Audit rows of every record of the queue: decided, dropped as a copy, unusable, or without a vehicle."""

    def line(df: DataFrame, step: str, what, used: str, rule: str) -> DataFrame:  # noqa: ANN001
        return df.select(
            "ticket_id", F.lit(step).alias("step"), what.alias("decision"), F.lit(used).alias("data_used"),
            F.lit(rule).alias("rule_id"), F.lit("pipeline").alias("actor"), F.col("created_at").alias("at"),
        )

    copies = done.duplicates.groupBy("ticket_id").agg(F.count(F.lit(1)).alias("n"), F.min("created_at").alias("created_at"))
    invalid = done.invalid.withColumn("ticket_id", validate.quarantine_key("ticket_id", "raw_json"))
    return (
        decision.audit_lines(done.decided, rules)
        .unionByName(line(copies, "dedupe", F.concat(F.col("n").cast("string"), F.lit(" further copies left out, the first one counts")), source_file, "DEDUPE-FIRST"))
        .unionByName(line(invalid, "validate", F.concat(F.lit("quarantined: "), F.array_join("reasons", ", ")), source_file, "VALIDATE-CRITICAL-FIELDS"))
        .unionByName(line(done.orphans, "enrich", F.concat(F.lit("quarantined: no fleet vehicle for "), F.col("vehicle_reg")), "vehicles", "ENRICH-VEHICLE-EXISTS"))
    )


def made_by(inputs: decision.Inputs, salt: str, source_file: str = "queue", rules: Sequence[Rule] = tuple(DEFAULT_RULES)) -> dict[str, DataFrame]:
    """What a run of the queue makes: orders, messages, quarantine rows and audit rows, whatever is stored already.

    A record whose message would carry personal data gets no order and no message but a quarantine row; the
    others are not held up by it.
    """
    # Parsed once: the decision, copies, unusable records and those without a vehicle all read the queue.
    inputs = replace(inputs, tickets=stage(inputs.tickets, "tickets"))
    done = decision.decide(inputs, rules)
    done = decision.Decision(stage(done.decided, "decided"), done.duplicates, stage(done.invalid, "invalid"), stage(done.orphans, "orphans"))
    exclusions = select.exclusion_rules(rules)
    # Drafted once: the gate and the outbox both read the messages.
    drafted = stage(assemble.draft_messages(done.decided, exclusions), "messages")
    failed = stage(leaking(drafted), "leaking")
    done = decision.Decision(done.decided.join(failed, "ticket_id", "left_anti"), done.duplicates, done.invalid, done.orphans)
    held = failed.select("ticket_id", F.lit("error").alias("step"), F.lit(f"quarantined: {LEAK}").alias("decision"))
    lines = audited(done, rules, source_file)
    return {
        "work_orders": assemble.build_orders(done.decided),
        "comms": drafted.join(failed, "ticket_id", "left_anti"),
        "quarantine": quarantined(done, salt, source_file).unionByName(_isolated(inputs.tickets, failed, salt, source_file)),
        "audit": lines.unionByName(held.withColumns({"data_used": F.lit("comms"), "rule_id": F.lit("ISOLATE-RECORD"), "actor": F.lit("pipeline")}), allowMissingColumns=True),
    }


def run_queue(
    inputs: decision.Inputs, root: str, batch: str, salt: str, source_file: str = "queue",
    rules: Sequence[Rule] = tuple(DEFAULT_RULES),
) -> DataFrame:
    """Run one queue and add what is new to the tables under ``root``; one row per table with the rows added.

    A queue that runs again adds nothing; ``replayed`` counts its orders that were stored before. All tables
    of a batch become visible together. Keys compare with those stored before, so two queues may share records.
    """
    frames, again = {}, None
    for name, df in made_by(inputs, salt, source_file, rules).items():
        keys, order = TABLES[name]
        df = stage(df, name)
        stored = outbox.state_for(df, root, name, _schema(df), keys, batch)
        frames[name] = stage(outbox.new_rows(df, stored, keys, order), name)
        if name == "work_orders":
            again = df.join(frames[name], keys, "left_anti")
    outbox.publish_batch(frames, root, batch, KEYS)
    return outbox.run_summary({**frames, "replayed": again})


def read_queue(spark: SparkSession, path: str, zone: str = T.DEFAULT_ZONE, keep_good: bool = False) -> DataFrame:
    """The queue files at ``path`` in canonical form, in the order of files and records.

    Files that can't be read, or a queue with too few known fields, stop the run. Items that are no objects
    stay as rows with ``is_object`` false, for the quarantine.
    """
    found = queue.scan_queue(spark, path, keep_good)
    found = found.select(F.struct("source_file", "pos").alias("pos"), "source_file", "shape", F.col("record").isNotNull().alias("is_object"), "raw", queue.flatten_once("record").alias("fields"))
    found = found.withColumn("fields", F.transform_values("fields", lambda k, v: F.try_variant_get(v, "$", "string")))
    found = stage(found, "queue")
    queue.gate_fatal(found)
    queue.gate_recognised(queue.matched_fields(found.where("is_object"), "fields"))
    # An array without elements has no items to judge.
    rows = queue.adapt_columns(found.where("is_object or raw is not null"), "fields")
    return domain.ticket_rows(rows, zone, F.col("raw"), ["is_object"])


def run_files(
    spark: SparkSession, path: str, fleet: DataFrame, history: DataFrame, people: DataFrame, root: str, batch: str, salt: str,
    rules: Sequence[Rule] = tuple(DEFAULT_RULES), zone: str = T.DEFAULT_ZONE, keep_good: bool = False,
) -> DataFrame:
    """Run the queue in files of any shape against canonical context tables; see ``read_queue`` and ``run_queue``."""
    tickets = read_queue(spark, path, zone, keep_good)
    return run_queue(decision.Inputs(tickets, fleet, history, people), root, batch, salt, path.rsplit("/", 1)[-1], rules)


def stored(spark: SparkSession, root: str, name: str) -> DataFrame:
    """All published rows of a stored table."""
    return outbox.read_state(spark, root, name, outbox.state_schema(spark, root, name))


def _with_sent(messages: DataFrame, sent: DataFrame) -> DataFrame:
    """Messages as they stand after the stored approvals."""
    done = sent.select("ticket_id", F.col("approved_by").alias("__by"), F.col("sent_at").alias("__at"))
    joined = messages.join(done, "ticket_id", "left")
    hit = F.col("__by").isNotNull()
    return joined.withColumns(
        {"status": F.when(hit, "sent").otherwise(F.col("status")), "approved_by": F.coalesce("__by", "approved_by"), "sent_at": F.coalesce("__at", "sent_at")}
    ).drop("__by", "__at")


def approve(spark: SparkSession, root: str, approvals: DataFrame, label: str) -> DataFrame:
    """Store approvals (ticket_id, approver, at) of messages under ``root``; each with its ``outcome``.

    A message becomes sent once, by the first valid approval that was stored; of one call's approvals the earliest
    counts, one without a time first. Later ones, those without approver and those of unknown tickets change nothing, and all are logged.
    Repeated rows are one approval. A call that is repeated under its label changes nothing and gives the same outcomes.
    """
    asked = stage(approvals.select(F.col("ticket_id").cast("string"), F.col("approver").cast("string"), T.utc_text("at").alias("at")).distinct(), "approvals")
    messages = outbox.state_for(asked, root, "comms", outbox.state_schema(spark, root, "comms"), KEYS["comms"])
    before = outbox.state_for(asked, root, "sent", APPROVED, KEYS["sent"], f"approvals:{label}")
    _, outcome = outbox.apply_approvals(_with_sent(messages, before), asked)
    log = outcome.select(content_id("APP", F.to_json(F.struct("ticket_id", "approver", "at"))).alias("approval_id"), "ticket_id", "approver", "at", "outcome")
    log = stage(log, "approval-log")
    sent = log.where("outcome = 'sent'").select("ticket_id", F.col("approver").alias("approved_by"), F.col("at").alias("sent_at"))
    logged = outbox.state_for(log, root, "approval_log", _schema(log), KEYS["approval_log"], f"approvals:{label}")
    new = outbox.new_rows(log, logged, ["approval_id"], ["outcome"])
    outbox.publish_batch({"sent": sent, "approval_log": new}, root, f"approvals:{label}", KEYS)
    return log


def export_run(
    spark: SparkSession, root: str, out: str, names: Sequence[str] = tuple(EXPORTS), patterns: Sequence[P.Pattern] = P.DEFAULT_PATTERNS
) -> None:
    """Write the named exports as sorted JSON lines under ``out``; every line passes the personal-data gate.

    Messages are pending or sent as the stored approvals have it (``approve``).
    """
    for name in names:
        table, chosen, fields = EXPORTS[name]
        df = stored(spark, root, table)
        if table == "comms":
            df = _with_sent(df, outbox.read_state(spark, root, "sent", APPROVED))
        if "raw_json" in df.columns:
            df = df.withColumn("raw", F.try_parse_json("raw_json"))
        for stamp in {"created_at", "detected_at", "at"} & set(df.columns):
            df = df.withColumn(stamp, T.utc_text(stamp))
        keys = TABLES[table][0]
        sink_jsonl_sorted(df.where(chosen), f"{out}/{name}", keys, fields, patterns)

"""State that only grows: insert once per key, publish in batches, approve once.

A state table is a folder of runs. A run counts only once the manifest names it, so a job that dies half-way
leaves nothing visible and can simply run again. Runs have a filter of their keys, so a batch opens only
what may hold its own keys. One writer at a time is assumed.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from adjudica.operators.dedupe import dedupe_first


def insert_absent(batch: DataFrame, state: DataFrame | None, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The batch's first row per key, with ``created``: false where the key is stored already."""
    first = dedupe_first(batch, keys, order)
    if state is None:
        return first.withColumn("created", F.lit(True))
    taken = state.select(*keys).distinct().withColumn("__taken", F.lit(True))
    return first.join(taken, list(keys), "left").withColumn("created", F.col("__taken").isNull()).drop("__taken")


def new_rows(batch: DataFrame, state: DataFrame | None, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Only the rows ``insert_absent`` would create."""
    first = dedupe_first(batch, keys, order)
    return first if state is None else first.join(state.select(*keys), list(keys), "left_anti")


# --- stored state ---------------------------------------------------------------------------------------

_MANIFEST = "kind string, name string, tbl string, level int, width long, n long, print long"
_BITS = 32_768  # of one bitmap, as Spark's bitmap aggregate has them
BITS_PER_KEY = 16
_NOT_IN_NAMES = re.compile(r"[^A-Za-z0-9_-]")
BUCKETS = 16
FAN_IN = 8  # runs of one level that are merged into one of the next


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _manifest(spark: SparkSession, root: str) -> tuple[int, list[Row]]:
    """The number of the last publication, and what is published: runs of tables, and batches with their content."""
    base, rows = 0, []
    saved = _read(spark, f"{root}/checkpoints", f"{_MANIFEST}, seq long")
    if saved is not None:
        base = saved.agg(F.max("seq")).first()[0] or 0
        rows = saved.filter(F.col("seq") == base).collect()
    since = _read(spark, f"{root}/published", f"{_MANIFEST}, seq long")
    if since is not None:
        rows += since.filter(F.col("seq") > base).collect()
    return max([base, *[r["seq"] for r in rows]]), rows


def _note(spark: SparkSession, path: str, rows: Sequence[Sequence[object]]) -> None:
    spark.createDataFrame(list(rows), _MANIFEST).coalesce(1).write.mode("errorifexists").parquet(path)


def _runs(rows: Sequence[Row], name: str) -> list[Row]:
    return [r for r in rows if r["kind"] == "run" and r["tbl"] == name]


def _hash(keys: Sequence[str], salt: int) -> Column:
    return F.xxhash64(*keys, F.lit(salt))


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(_hash(keys, 7), F.lit(BUCKETS)).cast("int") if keys else F.lit(0)


def _write_run(df: DataFrame, root: str, name: str, run: str, keys: Sequence[str], level: int) -> tuple[object, ...] | None:
    """Write the rows and their key filter as one run; its line for the manifest, none if there are no rows."""
    spark, path = df.sparkSession, f"{root}/{name}/run={run}"
    spread = df.repartition(*keys) if keys else df
    spread.withColumn("bucket", _bucket(keys)).write.partitionBy("bucket").parquet(path)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    written = _read(spark, path, schema)
    if written is None:
        return None
    row = F.to_json(F.struct(*[c for c in df.columns if c != "__batch"]))
    n, content = written.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(row))).first()
    if not n:
        return None
    width = 0
    if keys:
        width = 1 << max(0, -(-n * BITS_PER_KEY // _BITS) - 1).bit_length()
        at = F.explode(F.array(*[F.pmod(_hash(keys, k), F.lit(width * _BITS)) for k in (1, 2)]))
        bits = written.select(at.alias("at")).groupBy(F.expr(f"at div {_BITS}").alias("slot"))
        bits.agg(F.bitmap_construct_agg(F.col("at") % _BITS).alias("bits")).write.parquet(f"{root}/{name}_filter/run={run}")
    return "run", run, name, level, width, n, content


def publish_batch(frames: Mapping[str, DataFrame], root: str, batch: str, keys: Mapping[str, Sequence[str]] | None = None) -> bool:
    """Write one batch of several tables so that they become visible together; whether anything was added.

    A batch that was published before is left as it is if it has the same rows, and refused otherwise, so that
    a label used twice loses nothing. With ``keys`` a table is dealt into buckets and its run gets a filter of its
    keys. Every ``FAN_IN`` runs of a level become one of the next, so each row is rewritten a few times and a table
    has few runs, however many batches there were. One writer at a time; a second one fails at the manifest.
    """
    spark = next(iter(frames.values())).sparkSession
    last, rows = _manifest(spark, root)
    lines = []
    for name, df in frames.items():
        df.limit(0).write.mode("ignore").parquet(f"{root}/{name}_schema")
        run = f"{_NOT_IN_NAMES.sub('_', batch)}-{uuid.uuid4().hex}"
        lines.append((name, _write_run(df.withColumn("__batch", F.lit(batch)), root, name, run, list((keys or {}).get(name, ())), 0)))
    content = {name: (line[5], line[6]) if line else (0, 0) for name, line in lines}
    before = {r["tbl"]: (r["n"], r["print"]) for r in rows if r["kind"] == "batch" and r["name"] == batch}
    if before:
        if before != content:
            raise ValueError(f"batch {batch} was published with other rows")
        return False
    notes = [line for _, line in lines if line] + [("batch", batch, name, 0, 0, *content[name]) for name in frames]
    _note(spark, f"{root}/published/seq={last + 1}", notes)
    _merge(spark, root, keys or {})
    return True


def _merge(spark: SparkSession, root: str, keys: Mapping[str, Sequence[str]]) -> None:
    """Merge the runs of full levels, and note what is published in one place."""
    last, rows = _manifest(spark, root)
    merged = False
    for name in sorted({r["tbl"] for r in rows if r["kind"] == "run"}):
        for level in range(64):
            full = [r for r in _runs(rows, name) if r["level"] == level]
            if len(full) < FAN_IN:
                break
            stored = spark.read.option("basePath", f"{root}/{name}").parquet(*[f"{root}/{name}/run={r['name']}" for r in full]).drop("run", "bucket")
            line = _write_run(stored, root, name, f"level{level + 1}-{uuid.uuid4().hex}", list(keys.get(name, ())), level + 1)
            rows = [r for r in rows if r not in full] + [Row(**dict(zip(("kind", "name", "tbl", "level", "width", "n", "print"), line, strict=True)))]
            merged = True
    if merged:
        _note(spark, f"{root}/checkpoints/seq={last}", [tuple(r[c] for c in ("kind", "name", "tbl", "level", "width", "n", "print")) for r in rows])


def _open(spark: SparkSession, root: str, name: str, schema: str, runs: Sequence[str], other_than: str | None) -> DataFrame:
    if not runs:
        return spark.createDataFrame([], schema)
    paths = [f"{root}/{name}/run={r}" for r in runs]
    rows = spark.read.schema(f"{schema}, `__batch` string, run string, bucket int").option("basePath", f"{root}/{name}").parquet(*paths)
    return rows if other_than is None else rows.filter(F.col("__batch") != other_than)


def read_state(spark: SparkSession, root: str, name: str, schema: str, other_than: str | None = None) -> DataFrame:
    """All published rows of a state table; empty if there are none.

    A batch that runs again leaves out its own earlier attempt with ``other_than``, and so finds the
    same rows once more instead of its own keys taken.
    """
    _, rows = _manifest(spark, root)
    return _open(spark, root, name, schema, [r["name"] for r in _runs(rows, name)], other_than).drop("__batch", "run", "bucket")


def state_schema(spark: SparkSession, root: str, name: str) -> str:
    """The columns of a state table that was published at least once."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(f"{root}/{name}_schema").schema)


def state_for(batch: DataFrame, root: str, name: str, schema: str, keys: Sequence[str], other_than: str | None = None) -> DataFrame:
    """The published rows that may share a key with ``batch``, and few others.

    Every key of the batch is looked up in the filters of the table's runs. Only runs and buckets that may hold
    one are opened: a filter has 16 bits a key, so a run without any of a bucket's keys is opened needlessly by about
    one key in 70. Works like ``read_state`` for runs that were published without keys.
    """
    spark = batch.sparkSession
    _, rows = _manifest(spark, root)
    runs = _runs(rows, name)
    filtered = {r["name"]: r["width"] for r in runs if r["width"]}
    wanted = [F.col("run") == r["name"] for r in runs if not r["width"]]
    if filtered:
        each = F.explode(F.array(*[F.struct(F.lit(r).alias("run"), F.lit(w).cast("long").alias("width")) for r, w in filtered.items()]))
        probes = batch.select(*keys).distinct().select(_bucket(keys).alias("bucket"), _hash(keys, 1).alias("h1"), _hash(keys, 2).alias("h2"), each.alias("r"))
        probes = probes.select("bucket", "r.run", *[F.pmod(F.col(h), F.col("r.width") * _BITS).alias(h) for h in ("h1", "h2")])
        bits = spark.read.schema("slot long, bits binary, run string").option("basePath", f"{root}/{name}_filter").parquet(*[f"{root}/{name}_filter/run={r}" for r in filtered])
        for h in ("h1", "h2"):
            mine = bits.select("run", F.col("slot").alias("__slot"), "bits")
            probes = probes.withColumn("__slot", F.expr(f"{h} div {_BITS}")).join(mine, ["run", "__slot"])
            byte = F.conv(F.hex(F.substring("bits", (F.col(h) % _BITS / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
            probes = probes.filter(F.getbit(byte, (F.col(h) % 8).cast("int")) == 1).drop("__slot", "bits")
        for r in probes.groupBy("run").agg(F.collect_set("bucket").alias("buckets")).collect():
            wanted.append((F.col("run") == r["run"]) & F.col("bucket").isin(r["buckets"]))
    if not wanted:
        return spark.createDataFrame([], schema)
    rows_of = _open(spark, root, name, schema, [r["name"] for r in runs], other_than)
    return rows_of.filter(reduce(lambda a, b: a | b, wanted)).drop("__batch", "run", "bucket")


def apply_approvals(messages: DataFrame, approvals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages after approval, and one row per approval with its outcome.

    A pending message becomes sent by its first valid approval; later ones change nothing. Approvals
    without an approver or for an unknown ticket are refused.
    """
    who = F.nullif(F.trim("approver"), F.lit(""))
    named = approvals.withColumn("approver", who)
    first = (
        named.filter("approver is not null")
        .groupBy("ticket_id")
        .agg(F.min(F.struct("at", "approver")).alias("__a"))
    )
    due = F.col("status") == "pending"
    sent = messages.join(first, "ticket_id", "left").withColumns(
        {
            "sent_at": F.when(due & F.col("__a").isNotNull(), F.col("__a.at")).otherwise(F.col("sent_at")),
            "approved_by": F.when(due & F.col("__a").isNotNull(), F.col("__a.approver")).otherwise(F.col("approved_by")),
            "status": F.when(due & F.col("__a").isNotNull(), F.lit("sent")).otherwise(F.col("status")),
        }
    ).drop("__a")
    known = messages.select("ticket_id", F.col("status").alias("__status"))
    outcome = (
        named.join(known, "ticket_id", "left").join(first, "ticket_id", "left").withColumn(
            "outcome",
            F.when(F.col("approver").isNull(), "approver_required")
            .when(F.col("__status").isNull(), "unknown_ticket")
            .when(F.col("__status") != "pending", "already_sent")
            .when(F.struct("at", "approver") == F.col("__a"), "sent")
            .otherwise("already_sent"),
        ).drop("__status", "__a")
    )
    return sent, outcome


def approval_queue(messages: DataFrame) -> DataFrame:
    """Pending messages as the approver sees them, with the distinct rules they rest on."""
    rules = F.array_distinct(
        F.transform(
            F.filter("citations", lambda c: F.startswith(c["source"], F.lit("rules#"))),
            lambda c: c["source"].substr(F.lit(7), F.length(c["source"])),
        )
    )
    return messages.filter("status = 'pending'").select(
        "ticket_id", "recipient", "body", F.col("context.route").alias("route"),
        F.col("context.candidates_considered").alias("candidates_considered"),
        F.col("context.candidates_eligible").alias("candidates_eligible"),
        F.col("context.rejected").alias("rejected"), F.col("context.driver_constraints").alias("driver_constraints"),
        rules.alias("rules_cited"),
    )


def run_summary(outcomes: Mapping[str, DataFrame]) -> DataFrame:
    """One row per outcome with the number of records it had."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("outcome"), "n") for k, df in outcomes.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

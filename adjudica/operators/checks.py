"""Proofs about a run: nothing lost, nothing twice, nothing without a reason, nothing changed by a replay."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.functions.identity import content_fingerprint


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows against distinct keys; the keys are counted after a combine, not collected."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("n") > 1).alias("n_repeated"),
    )


def check_one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that do not have exactly one row on each side."""
    sides = left.select(*keys, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(*keys, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    return sides.groupBy(*keys).agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right")).filter(
        "n_left <> 1 or n_right <> 1"
    )


def check_not_blank(df: DataFrame, column: str) -> DataFrame:
    """Rows, and rows whose value is null or empty."""
    blank = F.col(column).isNull() | (F.trim(F.col(column)) == "")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(blank).alias("n_blank"))


def reconcile(expected: DataFrame, key: str, *places: DataFrame) -> DataFrame:
    """Expected keys found in none of the places; each place is a one-column frame named like the key."""
    found = reduce(DataFrame.unionByName, [p.select(key) for p in places])
    return expected.filter(F.col(key).isNotNull()).select(key).distinct().join(found, key, "left_anti")


def check_identifiable(df: DataFrame, key: str) -> DataFrame:
    """Records, and records nobody could name."""
    blank = F.col(key).isNull() | (F.trim(F.col(key)) == "")
    return df.agg(F.count(F.lit(1)).alias("n_records"), F.count_if(blank).alias("n_unidentifiable"))


def check_audited(orders: DataFrame, audit: DataFrame, key: str = "ticket_id") -> DataFrame:
    """Orders without a single audit line."""
    return orders.select(key).join(audit.select(key), key, "left_anti")


def check_replay(first: DataFrame, second: DataFrame) -> DataFrame:
    """Both fingerprints side by side, and whether they agree."""
    a = content_fingerprint(first).select(F.struct("*").alias("a"), F.lit(1).alias("k"))
    b = content_fingerprint(second).select(F.struct("*").alias("b"), F.lit(1).alias("k"))
    return a.join(b, "k").select(
        F.col("a.n_rows").alias("n_first"), F.col("b.n_rows").alias("n_second"), (F.col("a") == F.col("b")).alias("same")
    )


def cited_rules(citations: Column | str) -> Column:
    """The rule ids among citations, in order, repeats kept."""
    value = F.col(citations) if isinstance(citations, str) else citations
    rules = F.filter(value, lambda c: F.startswith(c["source"], F.lit("rules#")))
    return F.transform(rules, lambda c: c["source"].substr(F.lit(7), F.length(c["source"])))


def rule_usage(df: DataFrame, citations: str = "citations") -> DataFrame:
    """How often each rule is cited."""
    return df.select(F.explode(cited_rules(citations)).alias("rule_id")).groupBy("rule_id").agg(
        F.count(F.lit(1)).alias("n_cited")
    )


def rules_cited(citations: str = "citations") -> Column:
    """The distinct rules a row rests on, in order of first citation."""
    return F.array_distinct(cited_rules(citations))


def audited_keys(audit: DataFrame, key: str = "ticket_id") -> DataFrame:
    """The records with a trail."""
    return audit.select(key).distinct()


def ingest_report(tables: dict[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Per source: rows read and entities kept."""
    parts = []
    for name, (rows, entities) in tables.items():
        n = rows.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("source", F.lit(name))
        e = entities.agg(F.count(F.lit(1)).alias("n_entities")).withColumn("source", F.lit(name))
        parts.append(n.join(e, "source"))
    return reduce(DataFrame.unionByName, parts)

"""What was known as of a date.

History is first reduced to one row per (key, day), keeping which predicates held that day. A key's
window therefore holds at most one row per calendar day for its history and one per asked day, however
many rows the key has, so a hot key cannot overload a task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_latest(
    probes: DataFrame, history: DataFrame, key: str, at: str, on: str, predicates: Mapping[str, Column],
    carry: Sequence[str] | None = None,
) -> DataFrame:
    """For every asked (key, day): for each predicate, the latest day on or before it with a matching entry.

    One pass over history and probes together serves all predicates. Without ``carry`` the probes are
    made distinct first. With it they are taken as they are, and the named columns come along; the
    caller then sees to it that a key and a day do not repeat without bound.
    """
    days = history_days(history, key, on, predicates).select(
        key, F.col(on).alias("__day"), F.lit(0).alias("__ask"), *[F.when(F.col(n), F.col(on)).alias(n) for n in predicates]
    )
    known = probes.filter(F.col(key).isNotNull() & F.col(at).isNotNull())
    asked = known.select(key, at).distinct() if carry is None else known.select(key, at, *carry)
    asks = asked.select(
        key, F.col(at).alias("__day"), F.lit(1).alias("__ask"),
        *[F.lit(None).cast("date").alias(n) for n in predicates], *(carry or []),
    )
    upto = (
        Window.partitionBy(key).orderBy("__day", "__ask")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        days.unionByName(asks, allowMissingColumns=True)
        .select(key, "__day", "__ask", *[F.max(n).over(upto).alias(n) for n in predicates], *(carry or []))
        .filter("__ask = 1")
        .select(key, F.col("__day").alias(at), *predicates, *(carry or []))
    )


def history_days(history: DataFrame, key: str, on: str, predicates: Mapping[str, Column]) -> DataFrame:
    """One row per key and day of the history: for each predicate, whether an entry of that day meets it."""
    known = history.filter(F.col(key).isNotNull() & F.col(on).isNotNull())
    return known.groupBy(key, on).agg(*[F.bool_or(F.coalesce(p, F.lit(False))).alias(n) for n, p in predicates.items()])


def asof_join(
    probes: DataFrame, history: DataFrame, key: str, at: str, on: str, predicates: Mapping[str, Column]
) -> DataFrame:
    """The same answer by joining every probe with all its history; for checking, not for large inputs."""
    asks = probes.filter(F.col(key).isNotNull() & F.col(at).isNotNull()).select(key, at).distinct()
    past = history.select(
        F.col(key).alias("__key"), F.col(on).alias("__day"),
        *[F.when(p, F.col(on)).alias(n) for n, p in predicates.items()],
    )
    return (
        asks.join(past, (F.col(key) == F.col("__key")) & (F.col("__day") <= F.col(at)), "left")
        .groupBy(key, at)
        .agg(*[F.max(n).alias(n) for n in predicates])
    )


def days_past_due(last: Column, at: Column, interval: int) -> Column:
    """Days past the due date of the next event; null if there never was one."""
    return F.datediff(at, last) - F.lit(interval)


def days_since_event(last: Column, at: Column, none: int) -> Column:
    """Days since the event; ``none`` if it never happened, which is a known answer, not a gap."""
    return F.coalesce(F.datediff(at, last), F.lit(none))


def active_within(last: Column, at: Column, days: int) -> Column:
    """Whether the event happened at most ``days`` ago; false if it never did."""
    return F.coalesce(F.datediff(at, last) <= days, F.lit(False))


def null_gaps(names: list[str]) -> Column:
    """The names of those columns that are null, in the given order."""
    return F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in names]))


def previous_in_sequence(
    df: DataFrame, partition: str, ts: str, tie: str, value: str, out: str = "previous", bucket: str = "DAY"
) -> DataFrame:
    """The value of the row before this one in its partition's time order.

    A partition may hold a large share of all rows, so it is cut into time buckets: ``lag`` runs
    inside a bucket, and a bucket's first row takes the last value of the latest earlier bucket,
    found in a table with one row per (partition, bucket).
    """
    cut = df.withColumn("__bucket", F.date_trunc(bucket, F.col(ts)))
    inside = Window.partitionBy(partition, "__bucket").orderBy(ts, tie)
    across = Window.partitionBy(partition).orderBy("__bucket")
    position = F.struct(ts, tie)
    heads = (
        cut.groupBy(partition, "__bucket")
        .agg(F.max_by(F.struct(F.col(value).alias("v")), position).alias("__last"))
        .withColumn("__before", F.lag("__last").over(across))
        .drop("__last")
    )
    boxed = cut.withColumn("__prev", F.lag(F.struct(F.col(value).alias("v"))).over(inside))
    joined = boxed.join(
        heads.withColumnsRenamed({partition: "__p", "__bucket": "__b"}),
        F.col(partition).eqNullSafe(F.col("__p")) & F.col("__bucket").eqNullSafe(F.col("__b")), "left",
    )
    return joined.withColumn(out, F.coalesce("__prev", "__before")["v"]).drop(
        "__bucket", "__prev", "__before", "__p", "__b"
    )

"""Who was in which state on a day, from spells instead of one row per member and day.

A member's state changes on few days, so it is kept as spells: runs of days over which nothing changes. To ask
who is in a state on many days, the calendar is cut into blocks of 1, 2, 4 ... days. A spell is the union of a
few blocks, at most two of each length, and a day lies in one block of each length. Counts and first ids are
gathered per block once, and a day adds up the blocks it lies in. Work follows the number of spells and of
asked days, never their product.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adjudica.operators.lookup import topk_per_key


def spells(states: DataFrame, key: str, day: str, state: Sequence[str], until: date) -> DataFrame:
    """Runs of rows with one state per key: key, the state's columns, ``since`` and ``upto``, the first day after.

    ``states`` has the state of each key from a day on until its next row, one row per key and day; the last
    one holds through ``until``. Neighbours with equal states, nulls included, become one spell.
    """
    w = Window.partitionBy(key).orderBy(day)
    whole = F.struct(*state)
    begun = states.withColumn("__before", F.lag(whole).over(w)).filter(~F.col("__before").eqNullSafe(whole))
    end = F.coalesce(F.lead(day).over(w), F.date_add(F.lit(until), 1))
    return begun.select(key, *state, F.col(day).alias("since"), end.alias("upto"))


def levels_of(first: date, last: date) -> int:
    """The longest block length, as a power of two, that days from ``first`` to ``last`` need."""
    return max((last - first).days, 0).bit_length()


def blocks(since: Column, upto: Column, levels: int) -> Column:
    """The blocks (level, block) whose union is the days ``since`` to before ``upto``, numbered from 0."""

    def of_level(level: Column) -> Column:
        size = F.pow(F.lit(2), level)
        lo, hi = F.ceil(since / size).cast("int"), F.floor(upto / size).cast("int")
        left = F.when((lo < hi) & (lo % 2 == 1), F.struct(level.alias("level"), lo.alias("block")))
        right = F.when((lo < hi) & (hi % 2 == 1), F.struct(level.alias("level"), (hi - 1).alias("block")))
        return F.array(left, right)

    return F.array_compact(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(levels)), of_level)))


def classes_on_days(
    runs: DataFrame, asked: DataFrame, pool: str, day: str, cid: str, state: Sequence[str], first: date, last: date, keep_ids: int
) -> DataFrame:
    """For every asked (pool, day) and state: ``n`` members in it and ``ids``, the first ``keep_ids`` of them.

    ``runs`` has pool, member, state, ``since`` and ``upto``; a member's spells do not overlap. ``asked`` has
    each (pool, day) once, days within ``first`` and ``last``. Both tables are read twice or more.
    """
    levels = levels_of(first, last)
    number = lambda c: F.datediff(c, F.lit(first))
    parts = runs.select(pool, *state, cid, F.explode(blocks(number(F.col("since")), number(F.col("upto")), levels)).alias("__at"))
    parts = parts.select(pool, *state, cid, "__at.level", "__at.block")
    keys = [pool, "level", "block", *state]
    sizes = parts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    # Sorting by one number first spares comparing five columns, most of them alike.
    heads = topk_per_key(parts.withColumn("__hash", F.xxhash64(*keys)), ["__hash", *keys], [F.col(cid)], keep_ids, "__rank").groupBy(*keys).agg(F.collect_list(cid).alias("ids"))
    same = [F.col(f"__h.{k}").eqNullSafe(F.col(f"__s.{k}")) for k in keys]
    # By merge: ids pack so well that a side of hundreds of megabytes looks small enough to broadcast.
    tree = sizes.alias("__s").join(heads.alias("__h").hint("merge"), same).select("__s.*", "ids")
    at = F.transform(F.sequence(F.lit(0), F.lit(levels)), lambda k: F.struct(k.alias("level"), F.floor(number(F.col(day)) / F.pow(F.lit(2), k)).cast("int").alias("block")))
    probes = asked.select(pool, day, F.explode(at).alias("__at")).select(pool, day, "__at.level", "__at.block")
    met = probes.join(tree.hint("merge"), [pool, "level", "block"])
    return met.groupBy(pool, day, *state).agg(
        F.sum("n").alias("n"), F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, keep_ids).alias("ids")
    )

"""First-wins and last-wins dedupe.

Every keep-one rule is a rank filter, which Spark prunes before the shuffle (WindowGroupLimit), so a
key that holds a large share of all rows reaches its task as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(names: Sequence[Column | str]) -> list[Column]:
    return [F.col(n) if isinstance(n, str) else n for n in names]


def _keep_one(df: DataFrame, partition: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    w = Window.partitionBy(*partition).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def _spread_nulls(keys: Sequence[str], order: Sequence[str]) -> list[Column]:
    """Partition columns under which a row with a null key meets no other row."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return [*_cols(keys), F.when(any_null, F.struct(*order))]


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row per key; rows with a null in the key are all kept. ``order`` must be unique per row."""
    return _keep_one(df, _spread_nulls(keys, order), _cols(order))


def dedupe_report(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The rows ``dedupe_first`` drops, each with the position of the copy that was kept.

    A group of copies may be huge, so it is never ranked: the first position per repeated key is an
    aggregate, joined back to the rows.
    """
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    firsts = (
        df.filter(known)
        .groupBy(*keys)
        .agg(F.min(F.struct(*order)).alias("kept"), F.count(F.lit(1)).alias("__n"))
        .filter("__n > 1")
        .drop("__n")
    )
    return df.join(firsts, list(keys)).filter(F.struct(*order) != F.col("kept"))


def insert_ignore(
    df: DataFrame, keys: Sequence[str], order: Sequence[str],
    stored: DataFrame | None = None, null_distinct: bool = True,
) -> DataFrame:
    """The rows to add: the first per key, none whose key is stored already.

    With ``null_distinct`` a null in the key equals nothing, as in a SQL unique constraint.
    """
    partition = _spread_nulls(keys, order) if null_distinct else _cols(keys)
    first = _keep_one(df, partition, _cols(order))
    if stored is None:
        return first
    taken = stored.select(*keys).distinct()
    if null_distinct:
        return first.join(taken, list(keys), "left_anti")
    same = reduce(lambda a, b: a & b, [first[k].eqNullSafe(taken[k]) for k in keys])
    return first.join(taken, same, "left_anti")


def upsert_last(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], stored: DataFrame | None = None
) -> DataFrame:
    """The table after writing every row in order: the last row per key, stored rows where none is new."""
    last = [F.col(c).desc() for c in order]
    if stored is None:
        return _keep_one(df, _cols(keys), last)
    both = df.withColumn("__new", F.lit(1)).unionByName(
        stored.withColumn("__new", F.lit(0)), allowMissingColumns=True
    )
    return _keep_one(both, _cols(keys), [F.col("__new").desc(), *last]).drop("__new")

"""Which rows differ between two versions of a table, found by comparing hashes from the top down.

Keys are dealt into leaves of key hashes, leaves into branches, branches into one root. Each has its number of rows
and two sums over row hashes that don't depend on order. Levels are compared from the root; only leaves that differ
are opened, and only their rows are joined. Trees are small (`FAN` squared rows at most), so a stored one
lets a later run be compared without reading the earlier table at all, but for its differing leaves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.functions.identity import row_text

FAN = 256


def leaf_of(keys: Sequence[str], fan: int = FAN) -> Column:
    """The leaf a row's key belongs to, from 0 to ``fan`` squared."""
    return F.pmod(F.xxhash64(*keys), F.lit(fan * fan)).cast("int")


def hash_tree(df: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, fan: int = FAN) -> DataFrame:
    """``level`` (0 root, 1 branches, 2 leaves), ``node``, ``n``, ``bits``, ``total``: one row per node that has rows.

    ``columns`` are those compared, all by default, in name order, so that their order in the table doesn't matter.
    """
    names = sorted(columns or df.columns)
    h = F.xxhash64(row_text(names))
    leaves = df.select(leaf_of(keys, fan).alias("node"), h.alias("h")).groupBy("node").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor("h").alias("bits"), F.sum(F.shiftright("h", 20)).alias("total")
    )
    places = ((2, F.col("node")), (1, F.floor(F.col("node") / fan).cast("int")), (0, F.lit(0)))
    up = F.explode(F.array(*[F.struct(F.lit(level).alias("level"), node.alias("node")) for level, node in places]))
    each = leaves.select(up.alias("at"), "n", "bits", "total").select("at.level", "at.node", "n", "bits", "total")
    return each.groupBy("level", "node").agg(F.sum("n").alias("n"), F.bit_xor("bits").alias("bits"), F.sum("total").alias("total"))


def differing(left: DataFrame, right: DataFrame, level: int, among: Sequence[int] | None = None, fan: int = FAN) -> list[int]:
    """The nodes of a level in which two trees differ, below the given nodes of the level above."""
    sides = []
    for tree, sign in ((left, 1), (right, -1)):
        rows = tree.filter(F.col("level") == level)
        if among is not None:
            rows = rows.filter(F.floor(F.col("node") / fan).isin(list(among)))
        sides.append(rows.select("node", (F.col("n") * sign).alias("n"), "bits", (F.col("total") * sign).alias("total")))
    both = sides[0].unionByName(sides[1]).groupBy("node").agg(F.sum("n").alias("n"), F.bit_xor("bits").alias("bits"), F.sum("total").alias("total"), F.count(F.lit(1)).alias("sides"))
    return sorted(r["node"] for r in both.filter("n <> 0 or bits <> 0 or total <> 0 or sides <> 2").select("node").collect())


def drift(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, fan: int = FAN) -> DataFrame:
    """One row per row that only one side has or that differs: keys, ``change`` (added, removed, changed), ``columns`` that differ.

    Keys are unique and not null on each side. Equal tables give no rows after their roots were compared.
    """
    names = [c for c in sorted(columns or left.columns) if c not in keys]
    trees = [hash_tree(df, keys, [*keys, *names], fan) for df in (left, right)]
    nodes: list[int] | None = None
    for level in range(3):
        nodes = differing(*trees, level, nodes if level > 1 else None, fan)
        if not nodes:
            break
    opened = leaf_of(keys, fan).isin(nodes or [])
    sides = [df.filter(opened).select(*keys, F.struct(*names).alias(side)) for df, side in ((left, "__l"), (right, "__r"))]
    met = sides[0].join(sides[1], list(keys), "full")
    apart = F.array_compact(F.array(*[F.when(~F.col(f"__l.{c}").eqNullSafe(F.col(f"__r.{c}")), F.lit(c)) for c in names]))
    change = F.when(F.col("__l").isNull(), "added").when(F.col("__r").isNull(), "removed").when(F.size("columns") > 0, "changed")
    named = met.withColumn("columns", F.when(F.col("__l").isNotNull() & F.col("__r").isNotNull(), apart).otherwise(F.array().cast("array<string>")))
    return named.withColumn("change", change).filter("change is not null").select(*keys, "change", "columns")

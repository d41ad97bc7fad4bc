"""Connected components of a table of links, by rounds of union and find over tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.session import stage


def _roots(parents: DataFrame) -> DataFrame:
    """Follow ``child``, ``parent`` pointers (parent < child) to their ends, doubling the step each round."""
    while True:
        above = parents.select(F.col("child").alias("parent"), F.col("parent").alias("up"))
        joined = parents.join(above, "parent", "left")
        parents = stage(joined.select("child", F.coalesce("up", "parent").alias("parent"), F.col("up").isNotNull().alias("moved")), "roots")
        moved = parents.where("moved").limit(1).count()
        parents = parents.select("child", "parent")
        if not moved:
            return parents


def components(links: DataFrame) -> DataFrame:
    """``node``, ``root`` for every node of ``links`` (columns ``a``, ``b``): root is the smallest node reachable.

    Each round hooks every root to the smallest smaller root it is linked with, follows the pointers, and
    replaces the ends of the links by their roots; links inside one tree fall away. At least half of the
    roots that still have a link are hooked in each round. An empty table gives an empty table.
    """
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    labels: DataFrame | None = None
    while True:
        edges = stage(edges, "edges")
        if not edges.limit(1).count():
            break
        parents = _roots(edges.groupBy(F.col("b").alias("child")).agg(F.min("a").alias("parent")))
        if labels is None:
            labels = parents.select(F.col("child").alias("node"), F.col("parent").alias("root"))
        else:
            up = parents.select(F.col("child").alias("root"), F.col("parent").alias("up"))
            old = labels.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
            labels = old.unionByName(parents.join(labels.select(F.col("node").alias("child")), "child", "left_anti").select(F.col("child").alias("node"), F.col("parent").alias("root")))
        labels = stage(labels, "labels")
        for end in ("a", "b"):
            up = parents.select(F.col("child").alias(end), F.col("parent").alias("up"))
            edges = edges.join(up, end, "left").withColumn(end, F.coalesce("up", end)).drop("up")
        edges = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root")).limit(0)
    return labels.unionByName(labels.select(F.col("root").alias("node"), "root").distinct()).distinct()

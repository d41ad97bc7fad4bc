"""Keyed lookups, candidate joins, top-k, ordered exports and counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def lookup_left(
    df: DataFrame, dimension: DataFrame, key: str, dimension_key: str,
    columns: Mapping[str, str], found: str | None = None,
) -> DataFrame:
    """``df`` with dimension columns under new names, null where the key is unknown.

    The dimension has one row per key. No broadcast is forced: Spark broadcasts it below its size
    threshold and splits hot keys of ``df`` above it.
    """
    picked = [F.col(source).alias(name) for name, source in columns.items()]
    side = dimension.select(F.col(dimension_key).alias("__key"), *picked)
    out = df.join(side, F.col(key) == F.col("__key"), "left")
    if found is not None:
        out = out.withColumn(found, F.col("__key").isNotNull())
    return out.drop("__key")


def topk_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows per key with their rank; Spark prunes to ``k`` per key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def ordered_export(df: DataFrame, order: Sequence[Column | str], columns: Sequence[str]) -> DataFrame:
    """A projection in a total order."""
    return df.select(*columns).orderBy(*order)


def exists_semi(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key occurs in ``other``."""
    return df.join(other.select(*keys), list(keys), "left_semi")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def search_contains(df: DataFrame, column: str, term: str, order: str, limit: int = 40) -> DataFrame:
    """The first ``limit`` rows, by ``order``, whose text contains the term in any case."""
    return df.filter(F.contains(F.lower(F.col(column)), F.lit(term.lower()))).orderBy(order).limit(limit)

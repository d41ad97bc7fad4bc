"""Merging duplicate entity rows, and recording where they disagreed.

Everything is an aggregate with map-side combine, so an entity with very many copies costs no more
per reducer than one with two.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def resolve_entities(
    df: DataFrame, key: str, master: str, order: str, fields: Sequence[str]
) -> DataFrame:
    """One row per key.

    The survivor is the first row that carries a master id, else the first row. Its nulls are filled
    from the earliest row that has the value. ``<field>_row`` says which row a value came from.
    """
    rank = F.struct(F.col(master).isNull(), F.col(order))
    present = {f: F.when(F.col(f).isNotNull(), F.col(order)) for f in fields}
    grouped = (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.min_by(F.struct(*[F.col(f) for f in fields], F.col(order).alias("__row")), rank).alias("__s"),
            *[F.min_by(F.col(f), present[f]).alias(f"__v_{f}") for f in fields],
            *[F.min(present[f]).alias(f"__r_{f}") for f in fields],
            F.count(F.lit(1)).alias("n_rows"),
        )
    )
    own = F.col("__s")
    return grouped.select(
        key,
        *[F.coalesce(own[f], F.col(f"__v_{f}")).alias(f) for f in fields],
        own["__row"].alias(order),
        *[
            F.when(own[f].isNotNull(), own["__row"]).otherwise(F.col(f"__r_{f}")).alias(f"{f}_row")
            for f in fields
        ],
        *[own[f].isNotNull().alias(f"{f}_own") for f in fields],
        "n_rows",
    )


def entity_spellings(df: DataFrame, key: str, raw: str) -> DataFrame:
    """Every raw spelling of every key with its number of rows; blanks dropped."""
    text = F.nullif(F.col(raw), F.lit(""))
    return (
        df.filter(F.col(key).isNotNull() & text.isNotNull())
        .groupBy(F.col(key), F.col(raw).alias("spelling"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def value_text(df: DataFrame, name: str) -> Column:
    """A field as text; whole doubles without a trailing ``.0``."""
    text = F.col(name).cast("string")
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        text = F.regexp_replace(text, r"\.0$", "")
    return text


def _long(df: DataFrame, key: str, fields: Sequence[str], extra) -> DataFrame:
    entries = [
        F.struct(F.lit(f).alias("field"), value_text(df, f).alias("value"), *extra(f)) for f in fields
    ]
    return df.select(key, F.explode(F.array(*entries)).alias("e")).select(key, "e.*")


def field_conflicts(
    df: DataFrame, resolved: DataFrame, key: str, order: str, fields: Sequence[str],
    precedence: str = "PREC-CANONICAL-ROW", keep: str = "last",
) -> DataFrame:
    """Fields on which an entity's rows disagree: winning value, other value, and the row of each.

    ``keep='last'`` gives one row per (key, field), the disagreement written last when the rows are
    merged in order; ``keep='all'`` gives one per differing value.
    """
    rows = _long(df.filter(F.col(key).isNotNull()), key, fields, lambda f: [F.col(order).alias("at")])
    values = (
        rows.filter("value is not null")
        .groupBy(key, "field", "value")
        .agg(F.min("at").alias("first_row"), F.max("at").alias("last_row"))
    )
    winners = _long(
        resolved, key, fields,
        lambda f: [
            F.col(f"{f}_row").alias("winner_row"), F.col(order).alias("survivor_row"),
            F.col(f"{f}_own").alias("own"),
        ],
    ).withColumnRenamed("value", "winner")
    against = values.join(winners, [key, "field"])
    losing = F.col("value") != F.col("winner")
    if keep == "all":
        picked = against.filter(losing).select(
            key, "field", "winner", "winner_row", F.col("value").alias("loser"),
            F.col("last_row").alias("loser_row"),
        )
    else:
        # The latest differing row after the survivor; else what the rows before the survivor had
        # settled on when it replaced them; else the latest differing row.
        late = F.max_by(F.struct("value", "last_row"), F.when(losing, F.col("last_row")))
        early = F.min_by(
            F.struct("value", F.col("first_row").alias("last_row")),
            F.when(F.col("first_row") < F.col("survivor_row"), F.col("first_row")),
        )
        picked = (
            against.groupBy(key, "field")
            .agg(
                F.first("winner").alias("winner"), F.first("winner_row").alias("winner_row"),
                F.first("survivor_row").alias("survivor_row"), F.first("own").alias("own"),
                late.alias("late"), early.alias("early"),
            )
            .filter("late is not null")
            .withColumn(
                "lost",
                F.when(F.col("late.last_row") > F.col("survivor_row"), F.col("late"))
                .when(F.col("own") & (F.col("early.value") != F.col("winner")), F.col("early"))
                .otherwise(F.col("late")),
            )
            .select(
                key, "field", "winner", "winner_row", F.col("lost.value").alias("loser"),
                F.col("lost.last_row").alias("loser_row"),
            )
        )
    return picked.withColumn("rule_id", F.lit(precedence))


def cross_source_conflicts(
    claims: DataFrame, key: str = "entity", field: str = "field", value: str = "value",
    source: str = "source", rank: str = "source_rank",
) -> DataFrame:
    """Claims about one field from several sources: the best-ranked source wins, other values lose.

    Claims are first reduced to one row per value, so repeated claims cost nothing later.
    """
    best = F.struct(F.col(rank), F.col(source), F.col(value))
    values = claims.filter(F.col(value).isNotNull()).groupBy(key, field, value).agg(F.min(best).alias("claim"))
    winners = values.groupBy(key, field).agg(F.min("claim").alias("w"), F.count(F.lit(1)).alias("n"))
    return (
        values.join(winners.filter("n > 1"), [key, field])
        .filter(F.col(value) != F.col(f"w.{value}"))
        .select(
            key, field,
            F.col(f"w.{value}").alias("winner"), F.col(f"w.{source}").alias("winner_source"),
            F.col(value).alias("loser"), F.col(f"claim.{source}").alias("loser_source"),
        )
    )



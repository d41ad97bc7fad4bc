"""Audit of how five filters interact: what every order of applying them keeps, removes and loses.

A document's failures are five bits. Documents that agree in part and bits are one mask cell, whose weights
are its documents, its good ones and its toxic ones. Every cell folds over all 120 orders of the filters
with ``aggregate`` and ``transform`` into 600 weighted structs, one for each order and step, and the cells of
a part (32 at most) are merged by elementwise sums. The orders are a literal; work per document is one bit mask.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.session import stage

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MIN_WORDS, MIN_DISTINCT, MAX_UPPER, SYMBOLS = 200, 50, 2, "[#$%&*|]"  # words, per cent, per cent, one of
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
_SALTS = 1024


def text_bits(text: Column) -> Column:
    """Bits 0 to 3: the text fails filter A, B, C, D. ``text`` must not be null."""
    words = F.array_remove(F.split(text, SPACE), "")
    upper = F.length(text) - F.length(F.translate(text, UPPER, ""))
    failed = [
        F.size(words) < MIN_WORDS,
        100 * F.size(F.array_distinct(words)) < MIN_DISTINCT * F.size(words),
        100 * upper > MAX_UPPER * F.length(text),
        text.rlike(SYMBOLS),
    ]
    return reduce(Column.__add__, [F.when(f, 1 << k).otherwise(0) for k, f in enumerate(failed)])


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, ``bits``, ``n``, ``good``, ``toxic``: one row per mask cell that has documents.

    ``docs`` has doc_id, text and source, ``labels`` has doc_id, quality and toxic; other columns are not read.
    A null text is empty and a null source is the part ''. Filter E compares texts by their SHA-256 with
    the smallest id that has this text; rows with a null id neither fail it nor count as smaller, and rows that
    share the smallest id don't fail it. A document is good or toxic if any of its labels says so; one
    without label, or without id, is neither. Repeated rows of ``docs`` each count.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").alias("id"), F.coalesce("source", F.lit("")).alias("part"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("body"), text_bits(text).cast("int").alias("bits"))
    rows = stage(rows.withColumn("salt", F.when(F.col("id").isNull(), F.pmod(F.xxhash64("body", "part"), F.lit(_SALTS))).otherwise(F.lit(0).cast("bigint"))), "audit-bits")
    # Only texts that some later row repeats; the many copies of one text are combined before the exchange.
    first = rows.groupBy("body").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("last > first").drop("last")
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("int"), F.lit(0))).alias("good"), F.max(F.coalesce((F.col("toxic") == 1).cast("int"), F.lit(0))).alias("toxic")
    )
    marks = marks.where("good + toxic > 0").withColumn("salt", F.lit(0).cast("bigint"))
    placed = rows.join(marks, ["id", "salt"], "left").join(first, "body", "left")
    repeats = F.when(F.col("id") > F.col("first"), 1 << 4).otherwise(0)
    return placed.groupBy("part", (F.col("bits") + repeats).alias("bits")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("good", F.lit(0))).cast("long").alias("good"), F.sum(F.coalesce("toxic", F.lit(0))).cast("long").alias("toxic")
    )


def _fold(cell: Column) -> Column:
    """The 600 structs of one cell: for every order, step by step, its weights where they belong."""
    none = F.lit(0).cast("bigint")
    steps_type = f"array<struct<{','.join(f'{c}:bigint' for c in COUNTS)}>>"

    def step(state: Column, letter: Column) -> Column:
        fails = F.getbit(cell["bits"], letter) == 1
        here = state["alive"] & fails
        counts = F.struct(
            F.when(state["alive"] & ~fails, cell["n"]).otherwise(none).alias("kept"),
            F.when(here, cell["n"]).otherwise(none).alias("removed"),
            F.when(fails & ~state["alive"], cell["n"]).otherwise(none).alias("redundant"),
            F.when(fails & (F.bit_count(cell["bits"]) == 1), cell["n"]).otherwise(none).alias("unique_fails"),
            F.when(here, cell["good"]).otherwise(none).alias("good_lost"),
            F.when(here, cell["toxic"]).otherwise(none).alias("toxic_lost"),
        )
        return F.struct((state["alive"] & ~fails).alias("alive"), F.concat(state["steps"], F.array(counts)).alias("steps"))

    orders = F.array(*[F.array(*[F.lit(FILTERS.index(x)) for x in order]) for order in ORDERS])
    start = F.struct(F.lit(True).alias("alive"), F.array().cast(steps_type).alias("steps"))
    return F.flatten(F.transform(orders, lambda order: F.aggregate(order, start, step, lambda state: state["steps"])))


def audit(cells: DataFrame) -> DataFrame:
    """Per part, order and step the counts of ``COUNTS`` and ``shapley``, from the cells of ``masks``.

    Every part has all 600 rows, zeros included; no cells give no rows.
    """
    folded = cells.select("part", _fold(F.struct("bits", "n", "good", "toxic")).alias("steps"))
    add = lambda x, y: F.struct(*[(x[c] + y[c]).alias(c) for c in COUNTS])
    zeros = F.transform(F.sequence(F.lit(1), F.lit(len(ORDERS) * len(FILTERS))), lambda _: F.struct(*[F.lit(0).cast("bigint").alias(c) for c in COUNTS]))
    merged = folded.groupBy("part").agg(F.aggregate(F.collect_list("steps"), zeros, lambda sums, cell: F.zip_with(sums, cell, add)).alias("steps"))
    letters = F.array(*[F.lit(x) for order in ORDERS for x in order])
    of_filter = lambda k: F.aggregate(F.zip_with("steps", letters, lambda s, x: F.when(x == k, s["removed"]).otherwise(0)), F.lit(0).cast("bigint"), lambda a, b: a + b)
    merged = merged.withColumn("credit", F.create_map(*[c for k in FILTERS for c in (F.lit(k), of_filter(k))]))
    each = merged.select("part", "credit", F.posexplode("steps").alias("at", "counts"))
    order = F.get(F.array(*[F.lit(x) for x in ORDERS]), F.floor(F.col("at") / len(FILTERS)).cast("int"))
    each = each.select("part", "credit", order.alias("filter_order"), (F.col("at") % len(FILTERS) + 1).cast("int").alias("step"), "counts")
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    return each.select("part", "filter_order", "step", "counts.*", F.element_at("credit", letter).alias("shapley"))

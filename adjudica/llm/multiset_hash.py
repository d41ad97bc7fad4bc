"""Document fingerprints by a homomorphic multiset hash of paragraph parts.

Every part is hashed to a wide vector, and a document's fingerprint is the sum of its parts' vectors:
eight lanes modulo 2^32, which decide equality, and 128 lanes of one bit modulo 2^16, from which likeness is
read. The order of parts has no influence, and a part is put in or taken out by adding or subtracting its
vector, without the rest of the document. The squared length of the difference of two centred one-bit
vectors estimates how many parts the documents do not share.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adjudica.functions.binding import let
from adjudica.llm.shared import upto

PART = r"\n+|(?<=[.!?])\x20+"  # paragraphs, and the sentences of long ones, so that one edit leaves the rest
EQUAL, LIKE = 8, 128  # lanes
ROWS_PER_RANGE = 2_000
_LOW = 0xFFFFFFFF
_PAIR = 0x0000000100000001
_LANE16 = 0x0000FFFF0000FFFF


def parts(text: Column) -> Column:
    """The parts of a text, blank ones left out; none for a null text."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), PART), lambda p: F.trim(p) != "")


def _seeded(seed: int) -> Callable[[Column], Column]:
    return lambda part: F.xxhash64(part, F.lit(seed))


def fingerprint(text: Column) -> Column:
    """The vector of a text: count of parts, then equality lanes, then pairs of one-bit lanes, as array<bigint>.

    Lanes stand two to a number in the last group, 32 bits apart, and are counted without carry.
    """

    def total(hashes: Column, take: Callable[[Column, Column], Column]) -> Column:
        return F.aggregate(hashes, F.lit(0).cast("bigint"), lambda acc, h: take(acc, h))

    def vector(p: Column) -> Column:
        groups = [F.array(F.size(p).cast("bigint"))]
        for seed in range(EQUAL // 2):
            h = F.transform(p, _seeded(seed))
            low = total(h, lambda acc, x: (acc + x.bitwiseAND(F.lit(_LOW))).bitwiseAND(F.lit(_LOW)))
            high = total(h, lambda acc, x: (acc + F.shiftrightunsigned(x, 32)).bitwiseAND(F.lit(_LOW)))
            groups.append(F.array(low, high))
        for seed in range(LIKE // 64):
            h = F.transform(p, _seeded(100 + seed))
            shifts = F.sequence(F.lit(0), F.lit(31))
            lanes = let(
                h,
                lambda b: F.transform(
                    shifts,
                    lambda s: F.aggregate(
                        b,
                        F.lit(0).cast("bigint"),
                        lambda acc, x: (acc + F.call_function("shiftrightunsigned", x, s).bitwiseAND(F.lit(_PAIR))).bitwiseAND(F.lit(_LANE16)),
                    ),
                ),
            )
            groups.append(lanes)
        return F.concat(*groups)

    return let(parts(text), vector)


def combined(a: Column, b: Column, sign: int = 1) -> Column:
    """The vector of both documents' parts together, or of the parts of ``a`` without those of ``b``."""

    def lane(x: Column, y: Column, i: Column) -> Column:
        wide = (x + sign * y).bitwiseAND(F.lit(_LOW))
        half = lambda v, s: F.shiftrightunsigned(v, s).bitwiseAND(F.lit(0xFFFF))
        pair = lambda s: (half(x, s) + sign * half(y, s)).bitwiseAND(F.lit(0xFFFF))
        return F.when(i <= EQUAL, wide).otherwise(F.shiftleft(pair(32), 32).bitwiseOR(pair(0)))

    return F.transform(F.arrays_zip(a.alias("x"), b.alias("y")), lambda z, i: lane(z["x"], z["y"], i))


def as_text(vector: Column) -> Column:
    """The fingerprint as lower-case hex: 8 digits per equality lane and count, 4 per one-bit lane."""

    def digits(x: Column, i: Column) -> Column:
        pair = F.shiftleft(F.shiftrightunsigned(x, 32), 16).bitwiseOR(x.bitwiseAND(F.lit(0xFFFF)))
        return F.lpad(F.hex(F.when(i <= EQUAL, x).otherwise(pair)), 8, "0")

    return F.lower(F.array_join(F.transform(vector, digits), ""))


def likeness(a: Column, b: Column) -> Column:
    """1 minus the share of parts, counted in both documents, that the other one lacks, as the lanes estimate it.

    Equal fingerprints give 1, also two without parts. Exact counts would need the texts; the error is
    about 1 / sqrt(128) for unlike documents. Results are kept within 0 and 1.
    """

    def squares(value: Callable[[Column, int], Column]) -> Column:
        return F.aggregate(upto(EQUAL + 1, F.size(a) - 1), F.lit(0.0), lambda acc, i: acc + F.pow(value(i, 0), F.lit(2)) + F.pow(value(i, 32), F.lit(2)))

    def lane(v: Column, i: Column, shift: int) -> Column:
        return 2 * F.shiftrightunsigned(F.get(v, i), shift).bitwiseAND(F.lit(0xFFFF)).cast("double") - F.get(v, F.lit(0))

    own = squares(lambda i, s: lane(a, i, s))
    other = squares(lambda i, s: lane(b, i, s))
    apart = squares(lambda i, s: lane(a, i, s) - lane(b, i, s))
    return F.when(a == b, 1.0).when(own + other == 0, 0.0).otherwise(F.least(F.greatest(1 - apart / (own + other), F.lit(0.0)), F.lit(1.0)))


def _numbers(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def _range_of(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds lie below a key, looked up in two steps."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    fine = [bounds[i : i + step] for i in range(0, len(bounds), step)]

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b < key))

    lists = F.transform(F.split(F.lit(";".join(",".join(map(str, f)) for f in fine)), ";"), lambda t: F.split(t, ",").cast("array<bigint>"))
    coarse = below(_numbers([f[-1] for f in fine]))
    return let(coarse, lambda c: c * step + let(lists, lambda t: F.coalesce(below(F.get(t, c)), F.lit(0))))


def _ranges(keys: DataFrame, rows_per_range: int) -> tuple[list[int], list[tuple[int, int, int]]]:
    """Bounds that cut ``key`` into ranges, and per range its first key, itself, and the range before it."""
    count = max(1, min(10_000, math.ceil(keys.count() / rows_per_range)))
    shares = [i / count for i in range(1, count)]
    bounds = sorted(set(keys.agg(F.percentile_approx("key", shares, 10 * count)).first()[0] or [])) if shares else []
    found = keys.select(_range_of(F.col("key"), bounds).alias("range"), "key").groupBy("range").agg(F.max("key").alias("key"))
    heads = sorted(((r["range"], r["key"]) for r in found.collect()), reverse=True)
    return bounds, [(key, own, heads[k - 1][0]) for k, (own, key) in enumerate(heads)]


def _rows_of(spark: SparkSession, heads: list[tuple[int, int, int]]) -> DataFrame:
    text = F.explode(F.split(F.lit(";".join(",".join(map(str, h)) for h in heads)), ";")).alias("row")
    row = F.split("row", ",")
    return spark.range(1).select(text).select(row[0].cast("bigint").alias("key"), row[1].cast("int").alias("range"), row[2].cast("int").alias("into"))


def with_edits(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """Every row with its edited text, both fingerprints and their likeness.

    The edited text is the text with its last third (rounded down, code points) replaced by as many first
    code points of the next row, or all it has; next is by descending id, after the last comes the first.
    Rows are dealt out by ranges of ids, and the first row of each range is also dealt to the range before
    it, so that no task sees all rows. A null text counts as empty, a null id comes after all others, rows
    with equal ids follow by their text. A single row is its own next. Other columns are not looked at.
    """
    least = -(2**63)
    rows = docs.select(docs[id_column].alias("id"), F.coalesce(docs[id_column].cast("bigint"), F.lit(least)).alias("key"), F.coalesce(docs[text_column], F.lit("")).alias("text"))
    bounds, heads = _ranges(rows.select("key"), rows_per_range)
    whole = rows.withColumn("range", _range_of(F.col("key"), bounds))
    # At most 10,000 first keys.
    guests = whole.join(F.broadcast(_rows_of(docs.sparkSession, heads or [(0, 0, 0)])), ["key", "range"])
    guests = guests.groupBy("key", "into").agg(F.min("text").alias("text")).select(F.lit(None).cast(rows.schema["id"].dataType).alias("id"), "key", "text", F.col("into").alias("range"), F.lit(True).alias("guest"))
    both = whole.withColumn("guest", F.lit(False)).unionByName(guests).withColumn("vector", fingerprint(F.col("text")))
    order = Window.partitionBy("range").orderBy("guest", F.col("key").desc(), "text")
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    follow = both.withColumn("after", F.lead(F.struct("text", "vector")).over(order)).where(~F.col("guest"))
    edited = F.concat(F.left("text", n - third), F.left(F.col("after.text"), third))
    out = follow.select("id", "text", n.cast("bigint").alias("n_chars"), "vector", F.col("after.vector").alias("next_vector"), edited.alias("edited"))
    out = out.withColumn("edited_vector", fingerprint(F.col("edited")))
    return out.select(
        F.col("id").alias(id_column),
        "n_chars",
        "edited",
        "vector",
        "edited_vector",
        likeness(F.col("vector"), F.col("edited_vector")).alias("near_edited"),
        likeness(F.col("vector"), F.col("next_vector")).alias("near_next"),
    )

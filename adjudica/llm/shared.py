"""What several operators of this subpackage need: reading tables, ASCII lower case, row counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one input table (all of them when none is named)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def fold(id_column: Column, parts: int) -> Column:
    """crc32 of the id as text modulo ``parts``: how rows are held out, whatever their number."""
    return F.crc32(F.coalesce(id_column.cast("string"), F.lit("")).cast("binary")) % parts


def sample_filter(id_column: Column, rows: int, wanted: int, salt: int) -> Column:
    """Keeps about ``wanted`` of ``rows`` rows by a hash of their id, all when there are fewer.

    The number kept stays within a few standard deviations of ``wanted`` however large the table is.
    """
    if rows <= wanted:
        return F.lit(True)
    return F.pmod(F.xxhash64(id_column, F.lit(salt)), F.lit(1_000_000_007)) < int(1_000_000_007 * wanted / rows)


def workers_find_package(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver has it, if it isn't installed for them."""
    import os

    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


WORD_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """The words of a text: runs of a-z, 0-9 and characters beyond ASCII, after A-Z went to lower case."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), WORD_BREAK), "")


def upto(start: int | Column, end: Column) -> Column:
    """The whole numbers from ``start`` to ``end``, none if ``end`` is smaller."""
    first = F.lit(start).cast("int") if isinstance(start, int) else start
    return F.when(end >= first, F.sequence(first, end)).otherwise(F.array().cast("array<int>"))

"""Content-derived identifiers and fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_id(prefix: str, c: Column | str, width: int = 32) -> Column:
    """``PREFIX-`` and the first ``width`` hex digits of the value's SHA-256.

    Twelve digits, as short ids elsewhere have, collide among a few million values.
    """
    value = F.col(c) if isinstance(c, str) else c
    return F.concat(F.lit(prefix + "-"), F.substring(F.sha2(value.cast("string"), 256), 1, width))


def row_text(columns: Sequence[str]) -> Column:
    """One row as JSON text with nulls written and fields in the given order."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def content_fingerprint(df: DataFrame, columns: Sequence[str] | None = None, fast: bool = False) -> DataFrame:
    """Row count and two order-insensitive hashes of a table's content, combined map-side.

    A row's hash is the first 15 hex digits of the SHA-256 of its values as text, joined by a unit separator,
    with another one for null, so that any engine can state it; ``fast`` takes xxhash64 instead.
    """
    names = list(columns or sorted(df.columns))
    if fast:
        h = F.xxhash64(*names)
    else:
        text = F.concat_ws("\u001f", *[F.coalesce(F.col(n).cast("string"), F.lit("\u001e")) for n in names])
        h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 15), 16, 10).cast("long")
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.bit_xor(h), F.lit(0)).alias("xor_hash"),
        # Halves are summed apart so that the sum cannot overflow a long.
        F.coalesce(F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))), F.lit(0)).alias("sum_hash"),
    )

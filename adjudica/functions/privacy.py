"""Finding, masking and gating personal data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.functions.binding import let


@dataclass(frozen=True)
class Pattern:
    """One kind of personal data: how it looks in text, and what its canonical form keeps."""

    kind: str
    regex: str
    keep: str = "alnum"  # alnum | digits | last10 | lower
    hint: str | None = None  # a cheap pattern every text with a match also matches; it begins with a digit


# --- fixed values: kinds looked for, in masking order -------------------------------------------------
LICENCE = Pattern("DL", r"(?i)(?<![A-Za-z0-9_])[A-Z]{2}[-\s]?\d{2}[-\s]?\d{11}(?![A-Za-z0-9_])", "alnum", r"\d{11}")
NATIONAL_ID = Pattern(
    "AADHAAR", r"(?<![\w-])\d{4}\s\d{4}\s\d{4}(?![\w-])|(?<![\w-])\d{12}(?![\w-])", "digits", r"\d{4}\s\d{4}|\d{12}"
)
PHONE = Pattern(
    "PHONE",
    r"\+91[-\s]?\d{5}[-\s]?\d{5}(?![\w-])|\+91[-\s]?\d{10}(?![\w-])|(?<![\w-])[6-9]\d{9}(?![\w-])",
    "last10",
    r"91[-\s]?\d{5}|[6-9]\d{9}",
)
DEFAULT_PATTERNS = (LICENCE, NATIONAL_ID, PHONE)

# Kinds not on by default: e-mail and dotted-quad addresses.
EMAIL = Pattern("EMAIL", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}", "lower")
IPV4 = Pattern("IP", r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}", "alnum")

# 24 bits collide within a few thousand values and would merge join keys, so the default is longer.
TOKEN_WIDTH = 16


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _by_kind(kind: str, patterns: Sequence[Pattern]) -> Pattern:
    return next(p for p in patterns if p.kind == kind)


def _hint(patterns: Sequence[Pattern]) -> str:
    any_of = "|".join(f"(?:{p.hint or p.regex})" for p in patterns)
    # Most places in a text are ruled out by one character, without trying every alternative there.
    return rf"(?=\d)(?:{any_of})" if all(p.hint for p in patterns) else any_of


def mask_canonical(value: Column, keep: str) -> Column:
    """The part of a value all its spellings share, so masked columns still join."""
    digits = F.regexp_replace(value, "[^0-9]", "")
    if keep == "digits":
        return digits
    if keep == "last10":
        return F.right(digits, F.lit(10))
    if keep == "lower":
        return F.lower(value)
    return F.regexp_replace(F.upper(value), "[^A-Z0-9]", "")


def mask_token(value: Column, pattern: Pattern, salt: str, width: int = TOKEN_WIDTH) -> Column:
    """``[KIND:hex]`` of the salted SHA-256 of the canonical form."""
    if width in (10, 12):
        raise ValueError("a token of 10 or 12 digits could itself look like a phone or id number")
    text = F.concat_ws("|", F.lit(salt), F.lit(pattern.kind), mask_canonical(value, pattern.keep))
    return F.concat(F.lit(f"[{pattern.kind}:"), F.substring(F.sha2(text, 256), 1, width), F.lit("]"))


def mask_column(
    c: Column | str, kind: str, salt: str, width: int = TOKEN_WIDTH,
    patterns: Sequence[Pattern] = DEFAULT_PATTERNS,
) -> Column:
    """A whole column of one kind as tokens; blank and null give null."""
    value = F.nullif(F.trim(_col(c).cast("string")), F.lit(""))
    return F.when(value.isNotNull(), mask_token(value, _by_kind(kind, patterns), salt, width))


def mask_text(
    c: Column | str, salt: str, width: int = TOKEN_WIDTH,
    patterns: Sequence[Pattern] = DEFAULT_PATTERNS,
) -> Column:
    """Free text with every match replaced by its own token, pattern after pattern.

    The text between matches and the matches themselves are taken apart with ``split`` and
    ``regexp_extract_all`` and put together again, all inside the JVM. Text without digits in the
    right places, which is nearly all of it, only pays for one cheap search.
    """
    def masked(p: Pattern):
        def body(text: Column) -> Column:
            gaps = F.split(text, p.regex, -1)
            hits = F.regexp_extract_all(text, F.lit(p.regex), F.lit(0))
            tokens = F.transform(hits, lambda m: mask_token(m, p, salt, width))
            joined = F.array_join(F.zip_with(gaps, tokens, lambda g, t: F.concat(g, F.coalesce(t, F.lit("")))), "")
            return F.when(text.rlike(p.regex), joined).otherwise(text)

        return body

    def all_masked(text: Column) -> Column:
        out = text
        for p in patterns:
            out = let(out, masked(p))
        return F.when(text.rlike(_hint(patterns)), out).otherwise(text)

    if isinstance(c, str):
        # A column by name costs nothing to name twice, and only text that may hold a match needs the binding.
        return F.when(F.col(c).rlike(_hint(patterns)), let(F.col(c), all_masked)).otherwise(F.col(c))
    return let(_col(c), all_masked)


def has_pii(c: Column | str, patterns: Sequence[Pattern] = DEFAULT_PATTERNS) -> Column:
    """Whether any pattern occurs in the text; null text has none."""
    text = _col(c)
    hit = F.lit(False)
    for p in patterns:
        hit = hit | text.rlike(p.regex)
    return F.coalesce(text.rlike(_hint(patterns)) & hit, F.lit(False))


def find_pii(c: Column | str, patterns: Sequence[Pattern] = DEFAULT_PATTERNS) -> Column:
    """All hits in a text as ``array<struct<index,kind,length>>``, ordered by index then kind; index from 0."""
    none = F.array().cast("array<struct<index:int,kind:string,length:int>>")
    return let(
        _col(c), lambda text: F.when(text.rlike(_hint(patterns)), _hits(text, patterns)).otherwise(none)
    )


def _hits(text: Column, patterns: Sequence[Pattern]) -> Column:
    hit_type = "array<struct<index:int,kind:string,length:int>>"
    found = []
    for p in patterns:
        gaps = F.split(text, p.regex, -1)
        sizes = F.transform(F.regexp_extract_all(text, F.lit(p.regex), F.lit(0)), F.length)
        spans = F.zip_with(gaps, sizes, lambda g, n: F.struct(F.length(g).alias("gap"), n.alias("len")))
        start = F.struct(F.lit(0).alias("at"), F.array().cast(hit_type).alias("hits"))

        def step(acc: Column, span: Column) -> Column:
            at = acc["at"] + span["gap"]
            one = F.struct(at.alias("index"), F.lit(p.kind).alias("kind"), span["len"].alias("length"))
            hits = F.when(span["len"].isNull(), acc["hits"]).otherwise(F.concat(acc["hits"], F.array(one)))
            return F.struct((at + F.coalesce(span["len"], F.lit(0))).alias("at"), hits.alias("hits"))

        hits = F.aggregate(spans, start, step, lambda acc: acc["hits"])
        found.append(F.when(text.rlike(p.regex), hits).otherwise(F.array().cast(hit_type)))
    return F.array_sort(F.concat(*found))


def assert_clean(
    c: Column | str, label: str = "value", patterns: Sequence[Pattern] = DEFAULT_PATTERNS
) -> Column:
    """The value itself, or a failed job naming kinds and offsets, never the matched text."""
    text = _col(c)
    detail = F.array_join(
        F.transform(find_pii(text, patterns), lambda h: F.concat_ws("@", h["kind"], h["index"].cast("string"))), ", "
    )
    message = F.concat(F.lit(f"PII_LEAK in {label}: "), detail)
    return F.when(has_pii(text, patterns), F.raise_error(message).cast("string")).otherwise(text)


def gate_clean(
    df: DataFrame, columns: Sequence[str], label: str, patterns: Sequence[Pattern] = DEFAULT_PATTERNS
) -> DataFrame:
    """``df`` with every named text column behind ``assert_clean``."""
    gated = {n: assert_clean(F.col(n), f"{label}.{n}", patterns) for n in columns}
    return df.withColumns(gated)


def scan_leaks(
    df: DataFrame, columns: Sequence[str], by: Sequence[str], patterns: Sequence[Pattern] = DEFAULT_PATTERNS
) -> DataFrame:
    """Per group: rows scanned, rows with personal data in any named column."""
    dirty = F.lit(False)
    for n in columns:
        dirty = dirty | has_pii(F.col(n), patterns)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_scanned"), F.count_if(dirty).alias("n_leaking")
    )

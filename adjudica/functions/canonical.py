"""Canonical forms of dirty scalars. Total, null in gives null out, and applying one twice changes nothing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica import vocabulary as V
from adjudica.functions.binding import ascii_words, let


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column | str) -> Column:
    """The value, or null where it is the empty string."""
    return F.nullif(_col(c), F.lit(""))


def literal_map(mapping: Mapping[str, str]) -> Column:
    """A constant map column, for vocabularies held by the program."""
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def norm_key(c: Column | str) -> Column:
    """Upper case, letters and digits only: the key spellings of one identifier share."""
    return blank_to_null(F.regexp_replace(F.upper(_col(c)), "[^A-Z0-9]", ""))


def _squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def party_base(c: Column | str, suffixes: str = V.COMPANY_SUFFIXES) -> Column:
    """A party name without punctuation and company suffixes, before any alias lookup."""
    spaced = F.regexp_replace(F.lower(_col(c)), "[.,]", " ")
    return blank_to_null(_squeeze(F.regexp_replace(spaced, ascii_words(suffixes), " ")))


def slug(c: Column | str) -> Column:
    """Lower-case words joined by underscores."""
    return F.regexp_replace(F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]+", "_"), "^_|_$", "")


def norm_alias(
    c: Column | str, aliases: Mapping[str, str] = V.PARTY_ALIASES, suffixes: str = V.COMPANY_SUFFIXES
) -> Column:
    """A party's canonical name: alias if known, else a slug so unknown names still group."""
    known = literal_map(aliases)
    return let(party_base(c, suffixes), lambda b: F.coalesce(F.try_element_at(known, b), slug(b)))


def norm_alias_join(df: DataFrame, column: str, aliases: DataFrame, out: str) -> DataFrame:
    """``norm_alias`` with the aliases in a table (alias, canonical), for vocabularies that grow with the data."""
    lookup = aliases.groupBy(F.col("alias").alias("__alias")).agg(F.min("canonical").alias("__canonical"))
    base = party_base(column)
    return (
        df.withColumn("__base", base)
        .join(lookup, F.col("__base") == F.col("__alias"), "left")
        .withColumn(out, F.coalesce("__canonical", slug(F.col("__base"))))
        .drop("__base", "__alias", "__canonical")
    )


def norm_place(
    c: Column | str, aliases: Mapping[str, str] = V.PLACE_ALIASES, noise: str = V.PLACE_NOISE
) -> Column:
    """A place's canonical name: exact alias, else the longest alias it contains, else a slug."""
    text = F.regexp_replace(F.lower(_col(c)), r"\(.*?\)", " ")
    text = F.regexp_replace(F.regexp_replace(text, r"[^a-z\s]", " "), ascii_words(noise), " ")
    known = literal_map(aliases)
    longest_first = F.array(*[F.lit(a) for a in sorted(aliases, key=len, reverse=True)])

    def resolve(base: Column) -> Column:
        contained = F.get(F.filter(longest_first, lambda a: F.contains(base, a)), 0)
        return F.coalesce(
            F.try_element_at(known, base), F.try_element_at(known, contained), F.regexp_replace(base, r"\s+", "_")
        )

    return let(blank_to_null(_squeeze(text)), resolve)


def any_member(array: Column | str, members: Sequence[str]) -> Column:
    """True where the array holds any of the members; a null or empty array holds none."""
    wanted = F.array(*[F.lit(m) for m in members])
    return F.coalesce(F.arrays_overlap(_col(array), wanted), F.lit(False))


def norm_num(c: Column | str) -> Column:
    """A complete number after dropping thousands separators and a trailing unit, else null, never zero."""
    text = F.regexp_replace(F.trim(_col(c).cast("string")), ",", "")
    text = F.trim(F.regexp_replace(text, r"""[a-zA-Z%°"'\s]+$""", ""))
    # Text that is not a number extracts as the empty string, which casts to null.
    return F.regexp_extract(text, r"^[+-]?\d+(\.\d+)?$", 0).try_cast("double")


def norm_bool(
    c: Column | str, yes: Sequence[str] = V.TRUE_WORDS, no: Sequence[str] = V.FALSE_WORDS
) -> Column:
    """True, false, or null for anything else."""
    word = F.lower(F.trim(_col(c).cast("string")))
    return F.when(word.isin(*yes), F.lit(True)).when(word.isin(*no), F.lit(False))


def norm_enum(c: Column | str, values: Sequence[str] = V.SEVERITIES) -> Column:
    """The value in upper case where it is one of ``values``, else null."""
    word = F.upper(F.trim(_col(c)))
    return F.when(word.isin(*values), word)


def norm_stage(c: Column | str, prefix: str = "BS") -> Column:
    """A prefix and one digit, such as an emission stage, out of any spelling."""
    plain = F.regexp_replace(F.upper(_col(c)), "[^A-Z0-9]", "")
    digit = blank_to_null(F.regexp_extract(plain, prefix + r"(\d)", 1))
    return F.concat(F.lit(prefix), digit)


def norm_prefixed_id(c: Column | str, prefix: str = "DRV", width: int = 3) -> Column:
    """``PREFIX-nnn``: the digits after the prefix, zero-padded but never cut."""
    digits = blank_to_null(F.regexp_extract(F.upper(_col(c)), prefix + r"[^0-9]*(\d+)", 1))
    # Zeros go in front, then the surplus ones beyond ``width`` come off again.
    padded = F.regexp_replace(F.concat(F.lit("0" * width), digits), rf"^0{{1,{width}}}(?=\d{{{width},}}$)", "")
    return F.concat(F.lit(prefix + "-"), padded)


def classify_text(
    c: Column | str,
    classes: Sequence[tuple[str, str]] = tuple(V.COMPONENT_CLASSES),
    fallback_classes: Sequence[tuple[str, str]] = tuple(V.SYMPTOM_CLASSES),
    other: str = "other",
) -> Column:
    """The first class whose pattern the text matches; the fallback classes are asked only if none does."""
    text = blank_to_null(F.trim(_col(c)))
    label = F.when(text.isNull(), F.lit(None).cast("string"))
    for name, pattern in [*classes, *fallback_classes]:
        label = label.when(text.rlike("(?i)" + ascii_words(pattern)), F.lit(name))
    return label.otherwise(F.lit(other))

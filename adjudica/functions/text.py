"""Words, intents and snippets of questions and documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from adjudica import vocabulary as V
from adjudica.functions.binding import ascii_words, let

# Separators between words, the same for questions and for documents.
WORD_BREAK = r"""[\s,?.;:()"']+"""


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def words(c: Column | str) -> Column:
    """The words of a text, in order."""
    return F.filter(F.split(F.trim(_col(c)), WORD_BREAK), lambda w: w != "")


def distinct_sorted(array: Column) -> Column:
    """The distinct values of an array, sorted: n log n, where ``array_distinct`` compares all text pairs."""
    return let(
        F.sort_array(array), lambda s: F.filter(s, lambda w, i: (i == 0) | (w != F.get(s, i - 1)))
    )


def tokenize(c: Column | str, stop: Sequence[str] = V.STOP_WORDS, min_length: int = 3) -> Column:
    """Keywords: lower case, at least ``min_length`` letters, no stop words, in order."""
    lowered = F.transform(words(c), F.lower)
    return F.filter(lowered, lambda w: (F.length(w) >= min_length) & ~w.isin(*stop))


def tag_intents(c: Column | str, intents: Sequence[tuple[str, str]] = tuple(V.INTENTS)) -> Column:
    """The names of all intents a question matches, in the vocabulary's order."""
    text = F.trim(_col(c))
    return F.array_compact(
        F.array(*[F.when(text.rlike("(?i)" + ascii_words(regex)), F.lit(name)) for name, regex in intents])
    )


def snippet(text: Column | str, keywords: Column | str, width: int = 240) -> Column:
    """``width`` characters around the earliest keyword, or the head of the text if none occurs."""
    t, ks = _col(text), _col(keywords)
    spots = let(F.lower(t), lambda low: F.filter(F.transform(ks, lambda k: F.instr(low, k)), lambda i: i > 0))

    def around(first: Column) -> Column:
        start = F.greatest(F.lit(1), first - width // 3)
        cut = F.concat(
            F.when(start > 1, F.lit("…")).otherwise(F.lit("")), F.trim(F.substring(t, start, F.lit(width))), F.lit("…")
        )
        return F.when(first.isNull(), F.trim(F.substring(t, 1, width))).otherwise(cut)

    return let(F.array_min(spots), around)

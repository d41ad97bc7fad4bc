"""Naming an intermediate value inside one expression, and pattern helpers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` evaluated once however often the body uses it.

    Without this a value used n times is n copies of its expression, and nesting multiplies them
    until the generated code no longer compiles.
    """
    return F.get(F.transform(F.array(value), body), 0)


_WORD = "[A-Za-z0-9_]"
ASCII_BOUNDARY = f"(?:(?<={_WORD})(?!{_WORD})|(?<!{_WORD})(?={_WORD}))"


def ascii_words(pattern: str) -> str:
    """A pattern whose word boundaries look at ASCII letters only, on every Java version."""
    return pattern.replace(r"\b", ASCII_BOUNDARY)

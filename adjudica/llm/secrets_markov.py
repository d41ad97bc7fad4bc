"""Secret scan: fixed forms, and character Markov models of random strings and of ordinary identifiers.

Strings that a fixed form finds in any text are labelled random, the other identifiers of sampled texts ordinary.
Per class the counts of character pairs give the probability of a character after another one. A long
enough identifier outside the fixed forms is a secret if the logarithm of its likelihood ratio between the
two models, per character, reaches a threshold.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.functions.binding import let
from adjudica.llm.shared import sample_filter, upto

# Fixed forms: kind, pattern, and a cheap test that holds wherever the pattern can match.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "markov")

ORDINARY_ROWS = 2_000  # documents the ordinary identifiers are learned from, about
SHORTEST = 20  # characters of an identifier that is judged
THRESHOLD = 0.75  # per character, natural logarithm
IDENTIFIER = r"[A-Za-z0-9+/_=-]{%d,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
_SPANS = "array<struct<start:int,end:int,kind:int,text:string>>"


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratio of random against ordinary per pair of characters, by position in ``ALPHABET``."""

    ratio: tuple[float, ...]


def _none() -> Column:
    return F.array().cast(_SPANS)


def _matches(text: Column, pattern: str, kind: int) -> Column:
    """Spans of all matches, leftmost first: what stands between them gives their places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), lambda x: F.length(x))
    start = F.struct(F.lit(0).alias("at"), _none().alias("spans"))

    def places(m: Column, gaps: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            begin = acc["at"] + F.get(gaps, i)
            end = begin + F.length(F.get(m, i))
            span = F.struct(begin.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), F.get(m, i).alias("text"))
            return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

        return F.aggregate(upto(0, F.size(m) - 1), start, step, lambda acc: acc["spans"])

    return let(found, lambda m: let(between, lambda gaps: places(m, gaps)))


def fixed_forms(text: Column) -> Column:
    """Spans of the fixed forms, by start and then kind."""
    low = F.lower(text)
    keyword = low.contains(KEYWORDS[0])
    for k in KEYWORDS[1:]:
        keyword = keyword | low.contains(k)
    long_enough = lambda s: F.length(F.regexp_extract(s["text"], ASSIGN, 2)) >= 8
    assign = F.when(keyword, F.filter(_matches(text, ASSIGN, 0), long_enough)).otherwise(_none())
    access = F.when(text.contains("AKIA"), _matches(text, ACCESS, 1)).otherwise(_none())
    hexadecimal = F.when(text.rlike(HEX), _matches(text, HEX, 2)).otherwise(_none())
    return F.array_sort(F.concat(assign, access, hexadecimal))


def _outside(spans: Column, run: Column, shortest: int) -> Column:
    """The pieces of a run that no span (sorted by start) covers, those of ``shortest`` characters or more."""
    touching = F.filter(spans, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))
    start = F.struct(run["start"].alias("at"), _none().alias("pieces"))

    def until(acc: Column, end: Column) -> Column:
        text = F.substring(run["text"], acc["at"] - run["start"] + 1, end - acc["at"])
        piece = F.struct(acc["at"].alias("start"), end.alias("end"), run["kind"].alias("kind"), text.alias("text"))
        return F.when(end - acc["at"] >= shortest, F.concat(acc["pieces"], F.array(piece))).otherwise(acc["pieces"])

    def step(acc: Column, b: Column) -> Column:
        return F.struct(F.greatest(acc["at"], b["end"]).alias("at"), until(acc, b["start"]).alias("pieces"))

    return F.aggregate(touching, start, step, lambda acc: until(acc, run["end"]))


def _pair_counts(strings: DataFrame) -> dict[tuple[str, str], int]:
    chars = F.split("string", "")
    pairs = strings.select(F.explode(F.zip_with(chars, F.slice(chars, 2, F.greatest(F.length("string") - 1, F.lit(0))), lambda a, b: F.concat(a, b))).alias("pair"))
    # At most one row per pair of characters of the alphabet.
    return {tuple(r[0]): r[1] for r in pairs.where(F.length("pair") == 2).groupBy("pair").count().collect()}


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", ordinary_rows: int = ORDINARY_ROWS) -> Model:
    """Learn random strings from the fixed forms of all documents, ordinary identifiers from about so many.

    The latter are chosen by a hash of the id. Without any fixed form in the table nothing tells random strings
    apart, and every ratio is 0.
    """
    n = docs.count()
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    secrets = rows.select(F.explode(fixed_forms(F.col("text"))).alias("span"))
    value = F.when(F.col("span.kind") == 0, F.regexp_extract("span.text", ASSIGN, 2)).otherwise(F.col("span.text"))
    random = _pair_counts(secrets.select(value.alias("string")))
    plain = rows.where(sample_filter(F.col("id"), n, ordinary_rows, 33))
    for pattern in (ASSIGN, ACCESS, HEX):
        plain = plain.withColumn("text", F.regexp_replace("text", pattern, " "))
    words = plain.select(F.explode(F.regexp_extract_all("text", F.lit(IDENTIFIER % 4), F.lit(0))).alias("string"))
    ordinary = _pair_counts(words)
    k = len(ALPHABET)
    if not random or not ordinary:
        return Model((0.0,) * (k * k))

    def logs(counts: dict[tuple[str, str], int]) -> list[float]:
        out = []
        for a in ALPHABET:
            row = [counts.get((a, b), 0) + 0.5 for b in ALPHABET]
            out += [math.log(x / sum(row)) for x in row]
        return out

    return Model(tuple(a - b for a, b in zip(logs(random), logs(ordinary), strict=True)))


def _ratio(string: Column, model: Model) -> Column:
    """Log-likelihood ratio of a string per pair of characters."""
    table = F.split(F.lit(",".join(f"{x:.6g}" for x in model.ratio)), ",").cast("array<double>")
    codes = F.transform(F.split(string, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)
    k = len(ALPHABET)

    def mean(c: Column, t: Column) -> Column:
        total = F.aggregate(upto(1, F.size(c) - 1), F.lit(0.0), lambda acc, i: acc + F.coalesce(F.get(t, F.get(c, i - 1) * k + F.get(c, i)), F.lit(0.0)))
        return total / F.greatest(F.size(c) - 1, F.lit(1))

    return let(codes, lambda c: let(table, lambda t: mean(c, t)))


def _with_spans(docs: DataFrame, model: Model, text_column: str, shortest: int, threshold: float) -> DataFrame:
    """``docs`` with the columns ``_base`` and ``_added``."""
    text = F.coalesce(F.col(text_column), F.lit(""))
    rows = docs.withColumn("_base", fixed_forms(text))
    pattern = IDENTIFIER % shortest

    def random(base: Column) -> Column:
        pieces = F.flatten(F.transform(_matches(text, pattern, 3), lambda s: _outside(base, s, shortest)))
        return F.filter(pieces, lambda s: _ratio(s["text"], model) >= threshold)

    return rows.withColumn("_added", F.when(text.rlike(pattern), let(F.col("_base"), random)).otherwise(_none()))


def scan(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", shortest: int = SHORTEST, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` (id column) with ``base`` and ``added`` spans: start, end (code points), kind, text.

    ``kind`` is the place in ``KINDS``. Added spans never overlap base ones; of an identifier that touches base
    spans each piece outside them is judged, as far as it has ``shortest`` characters. A null text counts as empty;
    repeated rows give repeated rows; other columns are not looked at.
    """
    rows = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    found = _with_spans(rows, model, "text", shortest, threshold)
    return found.select(F.col("id").alias(id_column), F.col("_base").alias("base"), F.col("_added").alias("added"))


def redact(docs: DataFrame, model: Model, text_column: str = "text", mark: str = "[SECRET]", shortest: int = SHORTEST, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mark``; overlapping spans become one mark."""
    text = F.col(text_column)
    spans = by_start(F.concat("_base", "_added"))
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        between = F.concat(acc["done"], F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0))))
        fresh = (s["start"] >= acc["at"]) & (s["end"] > acc["at"])
        return F.struct(F.when(fresh, F.concat(between, F.lit(mark))).otherwise(acc["done"]).alias("done"), F.greatest(acc["at"], s["end"]).alias("at"))

    clean = F.aggregate(spans, start, step, lambda acc: F.concat(acc["done"], F.substring(text, acc["at"] + 1, F.length(text))))
    found = _with_spans(docs, model, text_column, shortest, threshold)
    whole = F.when(text.isNull() | (F.size("_base") + F.size("_added") == 0), text).otherwise(clean)
    return found.withColumn(text_column, whole).drop("_base", "_added")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def by_start(spans: Column) -> Column:
    """Spans by start, then kind."""
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))))
    return F.transform(order, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))

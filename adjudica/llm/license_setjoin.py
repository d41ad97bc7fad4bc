"""License scan: an exact set-similarity join of text blocks with license templates.

A block is a window of words; windows overlap by half and are twice as long as the longest template, so
that a template's words standing together always lie inside one block. A template is found in a block that
holds at least a given share of its different words. Tokens are ordered by their count in the whole corpus,
rarest first. A block that reaches the share must hold one of the first few tokens of the template in that
order (prefix filter), must have enough tokens at all (length filter), and after the first common token
both sides must have enough tokens left (positional filter). What passes is checked on the full sets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.functions.binding import let
from adjudica.llm.shared import upto, words_of

# Phrases and the labels they stand for (fixed by the contract of the query).
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Words by which licenses name themselves, and the label of each.
TEMPLATES = {
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "mit",
    "licensed under the apache license version 2 0": "apache-2.0",
    "licensed under the gnu general public license version 3": "gpl",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under a creative commons attribution 4 0 international license": "cc-by",
    "this is free and unencumbered software released into the public domain": "unlicense",
}
CONTAINMENT = 0.85


def places(words: Column, phrase: str) -> Column:
    """Starts (words from 0) of every place where the words of ``phrase`` stand one after the other."""
    wanted = phrase.split(" ")

    def here(i: Column) -> Column:
        test = F.get(words, i) == wanted[0]
        for k, w in enumerate(wanted[1:], 1):
            test = test & (F.get(words, i + k) == w)
        return test

    return F.filter(upto(0, F.size(words) - len(wanted)), here)


def _marked(joined: Column, phrase: str, label: str) -> Column:
    none = F.array().cast("array<struct<label:string,start:int>>")
    spans = F.transform(places(F.col("words"), phrase), lambda i: F.struct(F.lit(label).alias("label"), i.alias("start")))
    return F.when(joined.contains(f" {phrase} "), spans).otherwise(none)


def token_order(docs: DataFrame, tokens: list[str], text_column: str = "text") -> dict[str, int]:
    """How often each of the given tokens stands in all texts; the table returned has one entry per token."""
    words = docs.select(F.explode(words_of(docs[text_column])).alias("word")).where(F.col("word").isin(tokens))
    found = {r[0]: r[1] for r in words.groupBy("word").count().collect()}
    return {t: found.get(t, 0) for t in tokens}


def license_scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", phrases: dict[str, str] | None = None, templates: dict[str, str] | None = None, containment: float = CONTAINMENT) -> DataFrame:
    """One row per row of ``docs``: the id column, ``n_words``, ``found`` phrases (label, start) and ``blocks``.

    ``blocks`` lists, per block and label, the first and last word of the block, the label, and the share of the
    template's words it holds, for shares of at least ``containment``. Null and empty texts have no words
    and find nothing. Repeated rows give repeated rows; other columns are not looked at.
    """
    phrases, templates = phrases or PHRASES, templates or TEMPLATES
    sets = {t: sorted(set(t.split(" "))) for t in templates}
    tokens = sorted({w for s in sets.values() for w in s})
    counts = token_order(docs, tokens, text_column)
    rank = {w: k for k, w in enumerate(sorted(tokens, key=lambda w: (counts[w], w)))}
    stride = max(len(t.split(" ")) for t in templates)
    index = []
    for text, label in templates.items():
        ordered = sorted(sets[text], key=rank.__getitem__)
        least = -int(-containment * len(ordered) // 1)
        index += [(w, label, ordered, least, len(ordered) - at) for at, w in enumerate(ordered[: len(ordered) - least + 1])]
    prefix = sorted({row[0] for row in index})
    # One row per template and prefix token: a few dozen.
    literal = [F.struct(F.lit(w).alias("token"), F.lit(label).alias("label"), F.split(F.lit(" ".join(t)), " ").alias("template"), F.lit(least).alias("least"), F.lit(rest).alias("left")) for w, label, t, least, rest in index]
    known = F.broadcast(docs.sparkSession.range(1).select(F.inline(F.array(*literal))))

    rows = docs.select(docs[id_column].alias("id"), F.xxhash64(F.coalesce(docs[text_column], F.lit(""))).alias("body"), words_of(docs[text_column]).alias("words"))
    found = let(F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")), lambda j: F.concat(*[_marked(j, p, label) for p, label in phrases.items()]))
    at = F.filter(F.transform("words", lambda w, i: F.when(w.isin(prefix), F.floor(i / stride).cast("int"))), lambda i: i.isNotNull())
    # A token lies in the block of its own number and in the one before; -1 stands for the document itself.
    numbers = F.array_distinct(F.concat(F.array(F.lit(-1)), at, F.transform(at, lambda i: F.greatest(i - 1, F.lit(0)))))
    rows = rows.select("id", "body", "words", F.size("words").alias("n_words"), found.alias("found"), F.explode(numbers).alias("number"))
    first = F.col("number") * stride
    order = F.create_map(*[F.lit(x) for w in tokens for x in (w, rank[w])])
    # Only template tokens can be common: those of the block, in their global order.
    common = F.filter(F.array_distinct(F.slice("words", first + 1, 2 * stride)), lambda w: w.isin(tokens))
    inside = F.transform(F.array_sort(F.transform(common, lambda w: F.struct(order[w].alias("rank"), w.alias("word")))), lambda s: s["word"])
    blocks = rows.select(
        "id",
        "body",
        F.when(F.col("number") < 0, F.col("n_words")).alias("n_words"),
        F.when(F.col("number") < 0, F.col("found")).alias("found"),
        first.alias("first"),
        F.least(first + 2 * stride, F.col("n_words")).alias("last"),
        F.when(F.col("number") >= 0, inside).otherwise(F.array().cast("array<string>")).alias("inside"),
    )
    sent = blocks.select("*", F.explode_outer(F.filter("inside", lambda w: w.isin(prefix))).alias("token"))
    pairs = sent.join(known, "token", "left")
    # Both sides need enough tokens from the common one on, besides the ones before it that may be common.
    here = F.array_position("inside", F.col("token")).cast("int")
    possible = F.least(here - 1, F.size("template") - F.col("left")) + F.least(F.size("inside") - here + 1, F.col("left"))
    both = F.size(F.array_intersect("template", "inside"))
    enough = (F.size("inside") >= F.col("least")) & (possible >= F.col("least")) & (both >= F.col("least"))
    hit = F.when(enough, F.struct("first", "last", "label", (both / F.size("template")).alias("share")))
    grouped = pairs.groupBy("id", "body").agg(
        F.max("n_words").cast("bigint").alias("n_words"),
        F.max("found").alias("found"),
        F.count("n_words").cast("int").alias("copies"),
        F.array_sort(F.collect_set(hit)).alias("blocks"),
    )
    copies = F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    return grouped.select(F.col("id").alias(id_column), "n_words", "found", "blocks", copies).drop("copy")

"""Benchmark decontamination by winnowing.

A window is ten words. Of the 5-grams inside a window the one with the smallest hash is its fingerprint, so
two equal windows always have equal fingerprints, and neighbouring windows mostly share one: a document
sends one fingerprint per run of windows. Fingerprints that a benchmark item also has are hits; each is
extended to the windows of its run, and these are compared word for word. Nothing shared is missed, and
nothing is reported that is not shared. Items of fewer words are one window of their own length, with
shorter grams where needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.functions.binding import let
from adjudica.llm.shared import upto, words_of
from adjudica.session import stage

WINDOW, GRAM = 10, 5
BROADCAST_ROWS = 1_000_000  # fingerprints (8 bytes each) that are sent to every executor; more are shuffled


def _smallest(words: Column, length: int, gram: int) -> Column:
    """Per window of ``length`` words the smallest hash of its grams."""
    gram = min(gram, length)
    hashes = F.transform(words, lambda w: F.xxhash64(w))

    def grams(h: Column) -> Column:
        return F.transform(upto(0, F.size(h) - gram), lambda i: F.xxhash64(F.lit(length), *[F.get(h, i + k) for k in range(gram)]))

    def least(g: Column) -> Column:
        n = length - gram + 1
        return F.transform(upto(1, F.size(g) - n + 1), lambda i: F.array_min(F.slice(g, i, n)))

    return let(hashes, lambda h: let(grams(h), least))


def _runs(words: Column, length: int, gram: int) -> Column:
    """Runs of windows with one fingerprint: length of the windows, first and last start, fingerprint."""

    def cut(m: Column) -> Column:
        changes = F.filter(upto(0, F.size(m) - 1), lambda i: (i == 0) | (F.get(m, i) != F.get(m, i - 1)))
        return let(
            changes,
            lambda c: F.transform(
                upto(0, F.size(c) - 1),
                lambda t: F.struct(
                    F.lit(length).alias("length"),
                    F.get(c, t).alias("first"),
                    (F.coalesce(F.get(c, t + 1), F.size(m)) - 1).alias("last"),
                    F.get(m, F.get(c, t)).alias("print"),
                ),
            ),
        )

    return let(_smallest(words, length, gram), cut)


def _window(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start + 1, length), " ")


def item_windows(items: DataFrame, id_column: str = "item_id", text_column: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per different window: its words, length, fingerprint, and the ids (strings) of the items that hold it."""
    rows = items.select(F.coalesce(F.col(id_column).cast("string"), F.lit("null")).alias("item"), words_of(F.col(text_column)).alias("words")).where(F.size("words") > 0)
    parts = None
    for length in range(1, window + 1):
        here = rows.where(F.size("words") == length if length < window else F.size("words") >= window)
        spans = here.select("item", "words", F.lit(length).alias("length"), F.posexplode(_smallest(F.col("words"), length, gram)).alias("start", "print"))
        spans = spans.select("item", "length", "print", _window(F.col("words"), F.col("start"), F.lit(length)).alias("window"))
        parts = spans if parts is None else parts.unionByName(spans)
    return parts.groupBy("window", "length", "print").agg(F.array_sort(F.collect_set("item")).alias("items"))


def body_of(text: Column) -> Column:
    """Hash of a text, null counting as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def contamination(docs: DataFrame, items: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """One row per row of ``docs``: the id column, ``n_words``, ``hits`` (start and end word), ``items`` and ``body``.

    ``hits`` are all windows of the document that an item holds, ``items`` the sorted ids (strings) of those
    items, ``body`` tells rows of one id apart (``body_of`` their text). Null and empty texts have no words and no hits. Repeated rows give repeated rows, equal windows
    of several items name them all, an item with a null id is called ``null``. Other columns are not
    looked at.
    """
    known = stage(item_windows(items, text_column=text_column, window=window, gram=gram), "benchmark-windows")
    prints = known.select("print").distinct()
    lengths = sorted(r[0] for r in known.select("length").distinct().collect())
    words = F.col("words")
    rows = docs.select(docs[id_column].alias("id"), body_of(docs[text_column]).alias("body"), words_of(docs[text_column]).alias("words"))
    runs = F.concat(*[_runs(words, n, gram) for n in lengths]) if lengths else F.array().cast("array<struct<length:int,first:int,last:int,print:bigint>>")
    # A first entry without fingerprint stands for the document itself.
    itself = F.array(F.struct(F.lit(0).alias("length"), F.lit(-1).alias("first"), F.lit(-1).alias("last"), F.lit(None).cast("bigint").alias("print")))
    sent = F.concat(itself, runs)
    found = prints.withColumn("found", F.lit(True))
    count = F.when(F.col("run.first") < 0, F.col("size")).alias("n_words")
    own = F.slice("words", F.col("run.first") + 1, F.col("run.last") - F.col("run.first") + F.col("run.length"))
    if prints.count() <= BROADCAST_ROWS:
        each = rows.select("id", "body", "words", F.size("words").alias("size"), F.explode(sent).alias("run"))
        hit = each.join(F.broadcast(found), F.col("run.print") == F.col("print"), "left").where((F.col("run.first") < 0) | F.col("found"))
        # A hit is kept with its own words only, so that a long quotation isn't written once for each of its runs.
        hit = hit.select("id", "body", "run", count, F.when(F.col("run.first") >= 0, own).alias("words"))
    else:
        # Only hits go back to their texts; the texts themselves are not sent along with every fingerprint.
        light = rows.select("id", "body", F.size("words").alias("size"), F.explode(sent).alias("run")).select("id", "body", "run", count)
        matched = light.where("run.first >= 0").join(found, F.col("run.print") == F.col("print")).select("id", "body", "run").distinct()
        texts = rows.dropDuplicates(["id", "body"])
        matched = matched.join(texts, matched["id"].eqNullSafe(texts["id"]) & (matched["body"] == texts["body"])).select(matched["id"], matched["body"], "run", F.lit(None).cast("int").alias("n_words"), own.alias("words"))
        hit = light.where("run.first < 0").withColumn("words", F.lit(None).cast("array<string>")).unionByName(matched)
    hit = stage(hit, "benchmark-hits")
    starts = hit.select("id", "body", "n_words", F.col("run.length").alias("length"), F.col("run.first").alias("first"), "words", F.explode(F.sequence("run.first", "run.last")).alias("start"))
    starts = starts.select("id", "body", "n_words", "length", "start", F.when(F.col("start") >= 0, _window(F.col("words"), F.col("start") - F.col("first"), F.col("length"))).alias("window"))
    same = starts.join(known.select("window", "length", "items"), ["window", "length"], "left")
    place = F.when(F.col("items").isNotNull(), F.struct("start", (F.col("start") + F.col("length")).alias("end")))
    grouped = same.groupBy("id", "body").agg(
        F.max("n_words").alias("n_words"),
        F.count(F.when(F.col("start") < 0, 1)).alias("copies"),
        F.array_sort(F.collect_set(place)).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    copies = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return grouped.select(F.col("id").alias(id_column), F.col("n_words").cast("long").alias("n_words"), "hits", "items", "body", copies.alias("copy")).drop("copy")


def covered(hits: Column) -> Column:
    """How many words lie in at least one of the sorted spans."""
    empty = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))

    def step(acc: Column, h: Column) -> Column:
        gain = F.greatest(h["end"].cast("long") - F.greatest(acc["end"], h["start"].cast("long")), F.lit(0).cast("long"))
        return F.struct((acc["n"] + gain).alias("n"), F.greatest(acc["end"], h["end"].cast("long")).alias("end"))

    return F.aggregate(hits, empty, step, lambda acc: acc["n"])

"""Ranked search over bit-sliced Bloom signatures, exact for every document.

Documents stand in blocks. A block is a matrix of bits: a row (slice) is a bitmap over the block's documents,
and a term owns a few slices. A document has a term's slices set if it holds the term, and by chance a few
others, so the bitmaps overestimate presence and never miss. A term is entered again for each level of
occurrences it reaches, so the levels present bound its occurrences from above. Sums of the slices, weighted with
the terms' weights and what a level can add at the document's length, bound every document's score. Whatever
is not provably below an item's 20th best is scored exactly from its text.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adjudica.session import stage

TERM = rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
LEVELS = (1, 2, 3, 5, 9)  # occurrences from which a term is entered once more
HASHES, BITS_PER_ENTRY = 2, 10
BLOCK = 1024  # documents in a block
TERMS_AT_ONCE = 20_000  # terms of a block of items that one pass holds
_RUN = 4_000_000  # bytes of text worked on at once
_K1_TIMES_100, _B_TIMES_100 = 120, 25


def terms_of(text: str | None) -> list[bytes]:
    """The terms of a text in their order, A-Z in lower case."""
    return re.findall(TERM, text.encode("utf-8").lower()) if text else []


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id``, ``term``, ``times`` of the items' texts."""
    lower = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    each = items.select("item_id", F.explode(F.array_remove(F.split(lower, r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"), "")).alias("term"))
    return each.groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("times"))


def _seeds(terms: list[bytes]) -> np.ndarray:
    return pd.util.hash_array(np.array(terms, dtype=object), categorize=False) if terms else np.zeros(0, np.uint64)


def _slices(seeds: np.ndarray, level: int, width: int) -> np.ndarray:
    """The slices that (term, level) owns in a matrix of ``width`` slices, a power of two: one row per hash."""
    out = []
    for k in range(HASHES):
        x = (seeds + np.uint64(0x9E3779B97F4A7C15 * (2 * (level * HASHES + k) + 1) % 2**64)) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
        out.append(((x ^ (x >> np.uint64(32))) & np.uint64(width - 1)).astype(np.int64))
    return np.stack(out)


INDEX = "ids array<bigint>, bodies array<bigint>, lengths array<bigint>, most array<bigint>, width bigint, slices binary"


def _matrix(part: list[tuple], width: int) -> bytes:
    """The block's bits: slice after slice, each a bitmap over the documents."""
    bits = np.zeros((width, len(part)), np.uint8)
    for column, (_, _, _, _, seeds, times) in enumerate(part):
        for level, least in enumerate(LEVELS):
            bits[_slices(seeds[times >= least], level, width).reshape(-1), column] = 1
    return np.packbits(bits, axis=1, bitorder="little").tobytes()


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of documents of like numbers of entries, so that long documents don't fill the slices of short ones."""
    waiting: dict[int, list[tuple]] = {}
    schema = pa.schema([(n, pa.list_(pa.int64())) for n in ("ids", "bodies", "lengths", "most")] + [("width", pa.int64()), ("slices", pa.binary())])

    def block(width: int, part: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([[p[k] for p in part]], pa.list_(pa.int64())) for k in range(4)]
        return pa.RecordBatch.from_arrays([*columns, pa.array([width]), pa.array([_matrix(part, width)], pa.binary())], schema=schema)

    for batch in batches:
        ids, texts, bodies = batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist()
        for row in range(batch.num_rows):
            found = Counter(terms_of(texts[row].as_py()))
            if not found:
                continue
            times = np.fromiter(found.values(), np.int64, len(found))
            entries = sum(int((times >= least).sum()) for least in LEVELS)
            width = 1 << max(6, math.ceil(math.log2(entries * BITS_PER_ENTRY)))
            part = waiting.setdefault(width, [])
            part.append((ids[row], bodies[row], int(times.sum()), int(times.max()), _seeds(list(found)), times))
            # A wide block is a short one, so a matrix stays within a few megabytes of bits.
            if len(part) >= max(1, min(BLOCK, (1 << 26) // width)):
                yield block(width, waiting.pop(width))
    for width, part in waiting.items():
        yield block(width, part)


def build_index(docs: DataFrame) -> DataFrame:
    """The stored index of ``docs`` (doc_id, text): blocks of documents that hold a term. See ``INDEX``.

    ``bodies`` are hashes of the texts: rows that repeat an id are told apart by them. A text that is null or without
    term is in no block. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long"), docs["text"].alias("text"), F.xxhash64(docs["text"]))
    return stage(rows.mapInArrow(_signatures, INDEX), "bloom-index")


def document_frequencies(docs: DataFrame, terms: list[str]) -> dict[str, int]:
    """How many rows of ``docs`` hold each of ``terms``."""
    wanted = {t.encode("utf-8"): k for k, t in enumerate(terms)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(wanted), np.int64)
        for batch in batches:
            texts = batch.column(0)
            for row in range(batch.num_rows):
                for term in wanted.keys() & set(terms_of(texts[row].as_py())):
                    held[wanted[term]] += 1
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(held[at], pa.int64())], names=["term", "df"])

    found = docs.select("text").mapInArrow(count, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df"))
    return {terms[r["term"]]: r["df"] for r in found.collect()}


@dataclass(frozen=True)
class Model:
    """A block of items: their terms, weights and repeats, and the lengths that a score needs of all documents."""

    items: list[int]
    terms: list[bytes]
    weights: np.ndarray  # items x terms: weight times repeats
    documents: int
    length: int


def _share(times: np.ndarray | int, m: np.ndarray | int) -> np.ndarray | int:
    """What a term with that many occurrences adds per unit of weight, in whole numbers."""
    return (1_000_000_000 * times) // (1000 * times + _K1_TIMES_100 // 10 * m)


def _norm(n: np.ndarray | int, model: Model) -> np.ndarray | int:
    return 100 - _B_TIMES_100 + (_B_TIMES_100 * n * model.documents) // model.length


def _bounds(row: dict, model: Model, seeds: np.ndarray) -> np.ndarray:
    """An upper bound of the score of every item (rows) for every document of a block (columns)."""
    lengths, most = np.array(row["lengths"], np.int64), np.array(row["most"], np.int64)
    size = len(lengths)
    slices = np.frombuffer(row["slices"], np.uint8).reshape(row["width"], -1)
    m = _norm(lengths, model)
    total = np.zeros((len(model.items), size))
    before = np.zeros(size)
    for level, _ in enumerate(LEVELS):
        owned = _slices(seeds, level, row["width"])
        present = slices[owned[0]]
        for k in range(1, HASHES):
            present = present & slices[owned[k]]
        held = np.unpackbits(present, axis=1, bitorder="little", count=size)
        if not held.any():
            break
        top = most if level + 1 == len(LEVELS) else np.minimum(most, LEVELS[level + 1] - 1)
        reach = np.maximum(_share(top, m).astype(float), before)
        total += (model.weights.astype(np.float32) @ held.astype(np.float32)) * (reach - before)
        before = reach
    lost = 1e-7 * ((model.weights > 0).sum(axis=1).max() + 10)  # by single precision, at most
    return total * (1 + lost) + 1


def _bounded(model: Model, floors: np.ndarray | None, most: int | None):  # noqa: ANN202
    """Per block the documents of every item that reach its floor, or the ``most`` with the highest bounds."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = _seeds(model.terms)
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(k)[at].as_py() for k, name in enumerate(batch.schema.names)}
                bound = _bounds(row, model, seeds)
                # Only weighted terms count: what exceeds 1 holds one of them, perhaps.
                pick = bound > 1
                if floors is not None:
                    pick &= bound >= floors[:, None]
                elif bound.shape[1] > most:
                    nth = np.partition(bound, bound.shape[1] - most, axis=1)[:, bound.shape[1] - most]
                    pick &= bound >= nth[:, None]
                item, column = np.nonzero(pick)
                ids, bodies = pa.array(row["ids"], pa.int64()), pa.array(row["bodies"], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(item, pa.int32()), ids.take(pa.array(column)), bodies.take(pa.array(column)), pa.array(bound[item, column], pa.float64())], names=["item", "doc_id", "body", "bound"]
                )

    return work


_BOUND = "item int, doc_id bigint, body bigint, bound double"


def _scored(candidates: DataFrame, docs: DataFrame, model: Model) -> DataFrame:
    """``item``, ``doc_id``, ``score`` of the candidates (item, doc_id, body), exactly, from their texts."""
    wanted = candidates.groupBy(F.col("doc_id").alias("_id"), F.col("body").alias("_body")).agg(F.collect_set("item").alias("wanted"))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text"), F.xxhash64(docs["text"]).alias("body"))
    met = rows.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("body") == F.col("_body"))).select("doc_id", "text", "wanted")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = {t: k for k, t in enumerate(model.terms)}
        for batch in batches:
            item, doc, points = [], [], []
            for row in range(batch.num_rows):
                found = Counter(terms_of(batch.column(1)[row].as_py()))
                m = _norm(sum(found.values()), model)
                held = [t for t in places.keys() & found.keys()]
                share = np.array([_share(found[t], m) for t in held], np.int64)
                asked = np.array(batch.column(2)[row].as_py(), np.int64)
                item.append(asked)
                doc += [batch.column(0)[row].as_py()] * len(asked)
                points.append(model.weights[np.ix_(asked, [places[t] for t in held])] @ share)
            if item:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(item), pa.int32()), pa.array(doc, pa.int64()), pa.array(np.concatenate(points), pa.int64())], names=["item", "doc_id", "score"]
                )

    return met.mapInArrow(score, "item int, doc_id bigint, score bigint").where("score > 0")


def _best(scored: DataFrame, k: int, order: list[Column]) -> DataFrame:
    return scored.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def _item_blocks(pairs: DataFrame, at_once: int) -> Iterator[list[tuple[int, dict[str, int]]]]:
    """The items with their terms, so many at a time that they have about ``at_once`` terms."""
    grouped = pairs.groupBy("item_id").agg(F.collect_list(F.struct("term", "times")).alias("terms"))
    held, size = [], 0
    for row in grouped.orderBy("item_id").toLocalIterator():
        held.append((row["item_id"], {t["term"]: t["times"] for t in row["terms"]}))
        size += len(row["terms"])
        if size >= at_once:
            yield held
            held, size = [], 0
    if held:
        yield held


def search(docs: DataFrame, items: DataFrame, k: int = 20, index: DataFrame | None = None, at_once: int = TERMS_AT_ONCE) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: the ``k`` best documents of every item, all if fewer score above 0.

    Terms are runs of letters, digits and characters beyond ASCII, A-Z in lower case. Equal scores go by
    ascending doc_id, null last; every row of ``docs`` is a document, also one that repeats an id or a text. Null and
    termless texts are never found; items without a term have no rows, and neither has an empty table. Rows of
    ``items`` that repeat an id are one item with all their terms. Other columns are not read. Items are worked
    on in blocks of about ``at_once`` terms, which is what a pass sends to the workers.
    """
    index = build_index(docs) if index is None else index
    sizes = index.agg(F.sum(F.size("lengths")).alias("n"), F.sum(F.aggregate("lengths", F.lit(0).cast("bigint"), lambda a, b: a + b)).alias("l")).first()
    spark, out = docs.sparkSession, None
    for block in _item_blocks(item_terms(items), at_once) if sizes["n"] else ():
        terms = sorted({t for _, held in block for t in held})
        df = document_frequencies(docs, terms)
        place = {t: i for i, t in enumerate(terms)}
        weights = np.zeros((len(block), len(terms)), np.int64)
        for at, (_, held) in enumerate(block):
            for term, times in held.items():
                weights[at, place[term]] = times * math.floor(1000 * math.log((2 * sizes["n"] + 2) / (2 * df.get(term, 0) + 1)))
        model = Model([i for i, _ in block], [t.encode("utf-8") for t in terms], weights, sizes["n"], sizes["l"])
        likely = index.mapInArrow(_bounded(model, None, k), _BOUND)
        likely = _best(likely, k, [F.desc("bound"), F.asc_nulls_last("doc_id")])
        first = _best(_scored(likely, docs, model), k, [F.desc("score"), F.asc_nulls_last("doc_id")])
        floors = np.ones(len(block))
        for row in first.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least")).where(F.col("n") >= k).collect():
            floors[row["item"]] = row["least"]
        open_ = stage(index.mapInArrow(_bounded(model, floors, None), _BOUND), "bloom-open")
        found = _best(_scored(open_, docs, model), k, [F.desc("score"), F.asc_nulls_last("doc_id")])
        names = F.array(*[F.lit(i) for i in model.items])
        found = stage(found.select(F.get(names, F.col("item")).alias("item_id"), "rank", "doc_id", "score"), "bloom-best")
        out = found if out is None else out.unionByName(found)
    if out is None:
        schema = f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id bigint, score bigint"
        return spark.createDataFrame([], schema)
    return out

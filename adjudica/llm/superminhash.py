"""Near-duplicates by SuperMinHash signatures, banding, verification on full sets, and grouping.

Every shingle visits the slots of its document's signature in an order of its own, a random permutation
drawn step by step; at step j it offers the value j plus a random fraction. A slot keeps the smallest offer.
Once every slot holds less than the next step, no later step can change anything and the document is done,
after one or two steps for all but short documents. Slots agree with the probability of the sets'
likeness, with less variance than independent slots because a shingle ranks the slots without repeats.

Equal sets are one class, named by its smallest document. Classes meet in the buckets of their bands.
In a bucket nobody meets everybody: every class is checked against the bucket's head, its most central
class, and what that links is one group. Where a head still has classes of different groups, two of them can
only be alike if they differ from the head in the same way, so they meet over the rare changes they share,
with a prefix filter that loses no link. Checks compare full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adjudica.llm.components import components
from adjudica.session import stage

WORDS = 5
SIMILARITY = 75  # per cent
SLOTS, BANDS = 128, 32  # a pair of likeness 0.75 shares no band once in 200,000 pairs
_BATCH = 60_000  # shingles worked on at once

_M1, _M2, _GAMMA = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.array([(int(_GAMMA) * (2 * k + 1)) & (2**64 - 1) for k in range(WORDS)], dtype=np.uint64)


def _step(k: int) -> np.uint64:
    return np.uint64((int(_GAMMA) * k) & (2**64 - 1))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The distinct 5-word shingles of each text as sorted 64-bit hashes."""
    words = [t.encode("utf-8").lower().split() if t else [] for t in texts]
    sizes = [len(w) for w in words]
    flat = np.array([x for w in words for x in w], dtype=object)
    hashed = pd.util.hash_array(flat, categorize=False) if len(flat) else np.zeros(0, np.uint64)
    out, at = [], 0
    for n in sizes:
        h = hashed[at : at + n]
        at += n
        width = min(n, WORDS)
        if not n:
            out.append(np.zeros(0, np.uint64))
            continue
        total = np.full(n - width + 1, width, np.uint64) * _M2
        for k in range(width):
            total += _mix(h[k : n - width + 1 + k] ^ _PLACE[k]) * _PLACE[k]
        out.append(np.unique(_mix(total)))
    return out


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signature of every set; the row of an empty set stays infinite."""
    h = np.full((len(sets), slots), np.inf)
    flat = h.reshape(-1)
    doc = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    seed = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.uint32), (len(seed), 1))
    row = np.arange(len(seed))
    for j in range(slots):
        if not len(seed):
            break
        draw = _mix(seed + _step(2 * j + 1))
        pick = j + (_mix(seed + _step(2 * j + 2)) % np.uint64(slots - j)).astype(np.int64)
        slot = order[row, pick]
        order[row, pick] = order[row, j]
        np.minimum.at(flat, doc * slots + slot, j + (draw >> np.uint64(11)) * 2.0**-53)
        open_docs = h.max(axis=1) >= j + 1
        keep = open_docs[doc]
        if not keep.all():
            doc, seed, row = doc[keep], seed[keep], row[keep]
    return h


def _bands(signature: np.ndarray, bands: int) -> np.ndarray:
    rows = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), bands, -1)
    out = np.full(rows.shape[:2], _GAMMA) * (np.arange(bands, dtype=np.uint64) + np.uint64(1))
    for k in range(rows.shape[2]):
        out = _mix(out ^ rows[:, :, k]) * _GAMMA
    return out


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Position and shingle sets of runs of rows of bounded text."""
    at, held, size = 0, [], 0
    texts = batch.column(1)
    for k in range(batch.num_rows):
        held.append(texts[k].as_py())
        size += len(held[-1] or "")
        if size > 5 * _BATCH or k == batch.num_rows - 1:
            yield at, shingle_sets(held)
            at, held, size = k + 1, [], 0


def _sums(sets: list[np.ndarray]) -> np.ndarray:
    """Two sums over the mixed shingles of every set, which with its size tell sets apart."""
    return np.array([(_mix(s).sum(), _mix(s ^ _GAMMA).sum()) if len(s) else (0, 0) for s in sets], np.uint64).reshape(-1, 2).view(np.int64)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, sets in _groups(batch):
            bands = _bands(signatures(sets), BANDS).view(np.int64)
            sums = _sums(sets)
            offsets = np.arange(0, (len(sets) + 1) * BANDS, BANDS, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(at, len(sets)),
                    batch.column(2).slice(at, len(sets)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(sums[:, 0]),
                    pa.array(sums[:, 1]),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(bands.reshape(-1))),
                ],
                names=["doc_id", "body", "n", "f1", "f2", "bands"],
            )


def _full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at, sets in _groups(batch):
            offsets = np.cumsum([0] + [len(s) for s in sets]).astype(np.int32)
            values = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
            shingles = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
            columns = [batch.column(k).slice(at, len(sets)) for k in (0, 2, 3, 4)]
            yield pa.RecordBatch.from_arrays([*columns, shingles], names=["node", "best", "heads", "leads", "shingles"])


def _alike(similarity: int, size: Column, lost: Column, gained: Column) -> Column:
    """Whether a set that lost and gained so many of ``size`` shingles is alike enough."""
    return 100 * (size - lost) >= similarity * (size + gained)


def _differences(pairs: DataFrame, tops: DataFrame, changes: bool) -> DataFrame:
    """Per pair (``head``, ``node``, ``shingles`` of the node) the size of the head's set and how many shingles the node lost
    and gained; with ``changes`` also which these are."""
    both = pairs.join(tops.hint("merge"), "head")
    if not changes:
        common = F.size(F.array_intersect("top", "shingles")).cast("bigint")
        return both.select("head", "node", F.size("top").cast("bigint").alias("size"), (F.size("top") - common).alias("lost"), (F.size("shingles") - common).alias("gained"))
    both = both.select("head", "node", F.size("top").cast("bigint").alias("size"), F.array_except("top", "shingles").alias("out"), F.array_except("shingles", "top").alias("new"))
    return both.select("head", "node", "size", F.size("out").cast("bigint").alias("lost"), F.size("new").cast("bigint").alias("gained"), F.concat("out", "new").alias("changes"))


def _verified(pairs: DataFrame, sets: DataFrame, similarity: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose full sets are alike enough."""
    named = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    few = stage(sets.select("node", "shingles").join(named, "node", "left_semi"), "minhash-few")
    left = few.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = few.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(left, "a").join(right, "b").where(100 * both >= similarity * (F.size("sa") + F.size("sb") - both)).select("a", "b")


def _mixed(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``pairs`` (``head``, ``node``) whose head has classes of different groups."""
    own = groups.select(F.col("node").alias("head"), F.col("root").alias("head_root"))
    placed = pairs.select("head", "node").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = placed.groupBy("head").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).join(own, "head", "left")
    several = several.where((F.col("lo") < F.col("hi")) | (F.col("lo") != F.coalesce("head_root", "head")))
    return pairs.join(several.select("head"), "head", "left_semi")


def _candidates(apart: DataFrame, groups: DataFrame, similarity: int) -> DataFrame:
    """Pairs (``a``, ``b``) of different groups under one head that may be alike enough; none that is gets lost.

    Two classes have in common what neither lost, and the changes they share. With v = 100 lost + p gained, they
    are alike by p per cent just if (100 + p) shared >= v + v' - (100 - p) size. Classes that need no shared change
    are each linked with the head. So it is a join on shared changes with a prefix filter: a class sends its rarest
    changes, all but as many as it must share, to partners whose v is as large or larger.
    """
    weight = 100 * F.col("lost") + similarity * F.col("gained")
    slack, unit = (100 - similarity) * F.col("size"), 100 + similarity
    placed = apart.join(groups, "node", "left").withColumn("root", F.coalesce("root", "node")).withColumn("v", weight)
    n = F.size("changes")
    placed = placed.withColumn("as_probe", n - F.greatest(F.ceil((2 * F.col("v") - slack) / unit), F.lit(1)) + 1)
    placed = placed.withColumn("as_index", n - F.greatest(F.ceil((F.col("v") - slack) / unit), F.lit(1)) + 1)
    each = placed.where("as_index > 0").select("head", "node", "root", "v", "as_probe", "as_index", n.alias("n"), slack.alias("slack"), F.explode("changes").alias("change"))
    often = each.groupBy("head", "change").agg(F.count(F.lit(1)).alias("often"))
    order = Window.partitionBy("head", "node").orderBy("often", "change")
    each = each.join(often, ["head", "change"]).withColumn("rank", F.row_number().over(order))
    each = stage(each.where((F.col("rank") <= F.col("as_index")) & (F.col("often") > 1)).drop("often"), "minhash-prefixes")
    probe = each.where("rank <= as_probe").select("head", "change", "slack", F.col("node").alias("a"), F.col("root").alias("ra"), F.col("v").alias("va"), (F.col("n") - F.col("rank") + 1).alias("left_a"))
    index = each.select("head", "change", F.col("node").alias("b"), F.col("root").alias("rb"), F.col("v").alias("vb"), (F.col("n") - F.col("rank") + 1).alias("left_b"))
    # From the first change they share on, both need as many changes as they must share.
    needed = (F.col("va") + F.col("vb") - F.col("slack")) / unit
    met = probe.join(index, ["head", "change"]).where((F.col("ra") != F.col("rb")) & (F.col("va") <= F.col("vb")) & (F.least("left_a", "left_b") >= needed))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity: int = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: the id column, ``n_shingles``, ``component_id`` and ``kept``.

    Words are what stands between ASCII white space, A-Z in lower case. A text of fewer than five words is
    one shingle; a null or wordless text has none and is linked with nothing. ``component_id`` is the
    smallest id reachable over links. Rows that repeat an id are each linked and kept by their own text. A
    row with a null id is linked with nothing, has a null component and is kept. Other columns are not looked at.
    """
    return decisions(docs, id_column, text_column, similarity).select(F.col("doc_id").alias(id_column), "n_shingles", "component_id", "kept")


def decisions(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", similarity: int = SIMILARITY) -> DataFrame:
    """The rows of ``near_duplicates`` with ``doc_id``, ``body`` (xxhash64 of the text) and ``tie`` (of the set of shingles, null without)."""
    rows = docs.select(docs[id_column].cast("long").alias("doc_id"), docs[text_column].alias("text"), F.xxhash64(docs[text_column]).alias("body"))
    sketch = rows.mapInArrow(_sketch, "doc_id bigint, body bigint, n bigint, f1 bigint, f2 bigint, bands array<bigint>")
    # A class is named by the number of one of its rows, which is unique and short.
    sketch = stage(sketch.withColumn("row", F.monotonically_increasing_id()), "minhash-sketch")
    wordy = sketch.where("n > 0 and doc_id is not null")
    classes = stage(wordy.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("id"), F.min_by("row", "doc_id").alias("node")), "minhash-classes")
    nodes = sketch.select(F.col("row").alias("node"), "n", "bands").join(classes.select("node"), "node", "left_semi")
    places = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    sizes = places.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.min("n").alias("lo"), F.max("n").alias("hi"))
    # Two sets alone in a bucket must be of like sizes to be alike.
    sizes = sizes.where((F.col("size") > 2) | ((F.col("size") == 2) & (100 * F.col("lo") >= similarity * F.col("hi")))).select("bucket", "size")
    crowded = stage(places.select("node", "bucket").join(sizes, "bucket"), "minhash-buckets")
    # The head of a bucket is its most central class: the one that meets most others over all its buckets.
    degrees = crowded.groupBy("node").agg(F.sum("size").alias("degree"))
    heads = crowded.join(degrees, "node").groupBy("bucket").agg(F.max_by("node", "degree").alias("head"))
    shared = crowded.join(heads, "bucket").where("node <> head").groupBy("head", "node").count()
    shared = stage(shared, "minhash-heads")

    # The sets of all classes that share a bucket, each with its heads: the one it shares most bands with, and all.
    of_node = shared.groupBy("node").agg(F.max_by("head", "count").alias("best"), F.collect_list("head").alias("heads"))
    leading = shared.select(F.col("head").alias("node"), F.lit(True).alias("leads")).distinct()
    wanted = of_node.join(leading, "node", "full").withColumn("leads", F.coalesce("leads", F.lit(False)))
    wanted = wanted.join(sketch.select(F.col("row").alias("node"), "doc_id", "body"), "node")
    texts = rows.where("doc_id is not null").join(wanted.hint("merge"), ["doc_id", "body"]).dropDuplicates(["doc_id", "body"])
    texts = texts.select("node", "text", "best", "heads", "leads")
    sets = stage(texts.mapInArrow(_full, "node bigint, best bigint, heads array<bigint>, leads boolean, shingles array<bigint>"), "minhash-sets")
    tops = sets.where("leads").select(F.col("node").alias("head"), F.col("shingles").alias("top"))

    # First every class against the head it shares most bands with.
    first = sets.where("best is not null").select(F.col("best").alias("head"), "node", "shingles")
    first = _differences(first, tops, False)
    alike = _alike(similarity, F.col("size"), F.col("lost"), F.col("gained"))
    links = stage(first.where(alike).select(F.col("head").alias("a"), F.col("node").alias("b")), "minhash-links")

    # Then heads whose classes are in several groups: how each class differs from the head.
    mixed = _mixed(shared, components(links)).select("head").distinct()
    each = sets.where("best is not null").select("node", "shingles", F.explode("heads").alias("head"))
    apart = stage(_differences(each.join(mixed.hint("merge"), "head", "left_semi"), tops, True), "minhash-differences")
    links = stage(links.unionByName(apart.where(alike).select(F.col("head").alias("a"), F.col("node").alias("b"))), "minhash-links")
    groups = components(links)
    across = stage(_candidates(_mixed(apart, groups), groups, similarity), "minhash-across")
    links = links.unionByName(stage(_verified(across, sets, similarity), "minhash-links"))
    groups = components(links)

    # A component is named by its smallest id, and of classes that share it by the smallest hash of a set.
    tie = F.xxhash64("n", "f1", "f2").alias("tie")
    members = groups.join(classes.select("node", "id", tie), "node")
    smallest = members.groupBy("root").agg(F.min(F.struct("id", "tie")).alias("top"))
    named = sketch.join(classes, ["n", "f1", "f2"], "left").join(groups.join(smallest, "root").select("node", "top"), "node", "left")
    top = F.coalesce("top", F.when(F.col("node").isNotNull(), F.struct("id", tie)))
    return named.select(
        "doc_id",
        "body",
        F.when(F.col("node").isNotNull(), tie).alias("tie"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce(top["id"], "doc_id")).alias("component_id"),
        F.coalesce((F.col("doc_id") == top["id"]) & (tie == top["tie"]), F.lit(True)).alias("kept"),
    )

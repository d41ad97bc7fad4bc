"""Removal of repeated byte strings by a hash-compared suffix sort.

A string of 50 bytes that stands in two documents has the same smallest gram of 20 bytes in both, at the
same place. So every window of 50 bytes belongs to one anchor, its smallest gram, and only windows whose anchors
occur in several documents can repeat. Sets of anchors are exchanged first, as sorted codes cut to the bits
that the corpus needs; this filter loses no repeat and leaves a fraction of the text.

The surroundings of shared anchors then meet by gram. There their suffixes are sorted: prefix polynomial hashes tell by
binary search how far two suffixes agree, so a comparison takes logarithmic steps, and runs are merged pair by
pair, all groups side by side. Bytes confirm that the order is right, whatever the hashes say. Neighbours that
agree over 50 bytes are one string, and every document but the first that holds it loses these bytes.

Documents travel in compressed blocks that are written once; what comes back to a block are bits and intervals.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.session import stage

LENGTH = 50  # bytes of a repeated string
GRAM = 20  # bytes of an anchor
_REACH = LENGTH - GRAM + 1  # windows that can share an anchor
_WIDTH = LENGTH + _REACH - 1  # bytes they cover together

_ALONE = 255  # in place of an anchor: a window that meets its likes by its own hash
_PIECES = 10_000  # surroundings sorted at once

_BASE = 0x9E3779B97F4A7C15
_VALUES = np.random.default_rng(50).integers(1, 2**63, 256, dtype=np.uint64)  # what a byte counts in a hash


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base % 2**64, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


@dataclass(frozen=True)
class Sizes:
    """How work is cut up; results don't depend on it."""

    block: int = 1_200_000  # bytes of text in a block, half a megabyte packed; a longer document is a block of its own
    slice: int = 500_000  # bytes worked on at once
    bucket: int = 32_000_000  # bytes of the corpus for one bucket of an exchange
    hot: int = 1_000  # an anchor with more occurrences meets window by window


class Prefixes:
    """Polynomial hashes of all prefixes of a text modulo 2^64; any substring's hash follows in one step."""

    def __init__(self, data: np.ndarray, round_: int = 0) -> None:
        base = _BASE + 2 * round_
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * _powers(base, len(data)), out=self.sums[1:])
        self.back = _powers(pow(base, -1, 2**64), len(data) + 1)

    def of(self, at: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.sums[at + length] - self.sums[at]) * self.back[at]


def _freeze(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes, byte by byte of their numbers, which zeros and slow growth make small."""
    parts = [np.array([len(a) for a in arrays], np.int64).tobytes()]
    parts += [np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() for a in arrays]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _thaw(blob: bytes, *types: str) -> list[np.ndarray]:
    data, at, out = zstandard.ZstdDecompressor().decompress(blob), 8 * len(types), []
    for n, t in zip(np.frombuffer(data, np.int64, len(types)).tolist(), types, strict=True):
        size = np.dtype(t).itemsize
        out.append(np.ascontiguousarray(np.frombuffer(data, np.uint8, n * size, at).reshape(size, n).T).reshape(-1).view(t))
        at += n * size
    return out


def _deltas(sorted_: np.ndarray) -> np.ndarray:
    return np.diff(sorted_, prepend=sorted_[:1] * 0)


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and position inside the owner of as many places as ``counts`` says."""
    owner = np.repeat(np.arange(len(counts)), counts)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)


# Blocks.

_BLOCKS = "ids array<bigint>, sizes array<bigint>, prints array<binary>, packed binary"


def _packing(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    ids: list[int | None] = []
    sizes: list[int] = []
    texts: list[bytes] = []
    size = 0

    def block() -> pa.RecordBatch:
        packed = zstandard.ZstdCompressor(level=6).compress(b"".join(texts))
        # What can't hold a repeat needs no print.
        prints = [hashlib.blake2b(t, digest_size=16).digest() if len(t) >= LENGTH else None for t in texts]
        columns = [pa.array([list(ids)], pa.list_(pa.int64())), pa.array([list(sizes)], pa.list_(pa.int64())), pa.array([prints], pa.list_(pa.binary())), pa.array([packed], pa.binary())]
        out = pa.RecordBatch.from_arrays(columns, names=["ids", "sizes", "prints", "packed"])
        ids.clear(), sizes.clear(), texts.clear()
        return out

    for batch in batches:
        for row in range(batch.num_rows):
            ids.append(batch.column(0)[row].as_py())
            texts.append((batch.column(1)[row].as_py() or "").encode("utf-8"))
            sizes.append(len(texts[-1]))
            size += sizes[-1]
            if size >= most or len(sizes) >= 100_000:
                yield block()
                size = 0
    if ids:
        yield block()


def copies_in(blocks: DataFrame) -> DataFrame:
    """``block``, ``copies``: places in it of documents whose whole text a smaller id has as well; none of them is looked into."""
    each = blocks.select("block", F.posexplode(F.arrays_zip("ids", "prints")).alias("at", "doc")).select("block", "at", "doc.ids", "doc.prints")
    each = each.where("ids is not null and prints is not null")
    first = stage(each.groupBy("prints").agg(F.min("ids").alias("first"), F.max("ids").alias("last")).where("last > first").drop("last"), "suffix-copies")
    return each.join(first, "prints").where("ids > first").groupBy("block").agg(F.collect_list("at").alias("copies"))


def _opened(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """A block's bytes, the ends of its documents in them, their ids, and which documents have one."""
    data = zstandard.ZstdDecompressor().decompress(batch.column("packed")[row].as_py()) or b""
    ids = batch.column("ids")[row].as_py()
    known = np.array([i is not None for i in ids], bool)
    ends = np.cumsum(np.array(batch.column("sizes")[row].as_py(), np.int64))
    return np.frombuffer(data, np.uint8), ends, np.array([i or 0 for i in ids], np.int64), known


# Anchors.


def _evenly(grams: np.ndarray) -> np.ndarray:
    """Names of anchors that spread over all numbers; their hashes are smallest ones and crowd near zero."""
    return _mix(grams + np.uint64(_BASE))


def _anchors(data: np.ndarray, ends: np.ndarray, known: np.ndarray, slice_: int) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: gram, first window, number of windows, place of the anchor, document."""
    found = []
    for start in range(0, max(len(data) - LENGTH + 1, 0), slice_):
        part = data[start : start + slice_ + LENGTH - 1]
        prefixes, n = Prefixes(part), len(part) - LENGTH + 1
        grams = _mix(prefixes.of(np.arange(len(part) - GRAM + 1), GRAM))
        # The leftmost smallest gram of every window, by doubling the span looked at.
        place, least, span = np.arange(len(grams), dtype=np.int32), grams, 1
        while span < _REACH:
            more = min(span, _REACH - span)
            later = least[more:] < least[:-more]
            place = np.where(later, place[more:], place[:-more])
            least = np.where(later, least[more:], least[:-more])
            span += more
        at = np.arange(start, start + n)
        doc = np.searchsorted(ends, at, side="right")
        inside = (at + LENGTH <= ends[doc]) & known[doc]
        breaks = np.ones(n, bool)
        breaks[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(breaks & inside)
        if not len(first):
            continue
        # A run ends where the next begins or the document's windows end.
        edges = np.append(np.flatnonzero(breaks), n)
        stop = edges[np.searchsorted(edges, first, side="right")]
        stop = np.minimum(stop, ends[doc[first]] - LENGTH + 1 - start)
        found.append((_evenly(grams[place[first]]), first + start, stop - first, place[first].astype(np.int64) + start, doc[first]))
    if not found:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none, none, none
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _coded(batches: Iterator[pa.RecordBatch], bits: int, parts: int, slice_: int) -> Iterator[pa.RecordBatch]:
    """Per block and bucket the sorted codes of its anchors, how often each occurs, and whether in several documents."""
    for batch in batches:
        for row in range(batch.num_rows):
            data, ends, ids, known = _opened(batch, row)
            grams, _, _, _, doc = _anchors(data, ends, known, slice_)
            if not len(grams):
                continue
            code = grams >> np.uint64(64 - bits)
            order = np.lexsort((ids[doc], code))
            code, owner = code[order], ids[doc][order]
            first = np.flatnonzero(np.append(True, code[1:] != code[:-1]))
            last = np.append(first[1:], len(code)) - 1
            times = np.minimum(last - first + 1, 32_767) + 32_768 * (owner[first] != owner[last])
            codes, bucket = code[first], (code[first] >> np.uint64(bits - parts)).astype(np.int64)
            cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            blobs = [_freeze(_deltas(c), t) for c, t in zip(np.split(codes, cut[1:]), np.split(times.astype(np.uint16), cut[1:]), strict=True)]
            block = pa.array([batch.column("block")[row].as_py()] * len(cut), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(bucket[cut], pa.int64()), block, pa.array(blobs, pa.binary())], names=["bucket", "block", "codes"])


def _shared(rows: pd.DataFrame, hot: int) -> pd.DataFrame:
    """For every block of a bucket which of its codes occur in several documents (1), and which of them often (2)."""
    held = [_thaw(b, "u8", "u2") for b in rows["codes"]]
    code = np.concatenate([np.cumsum(h[0]) for h in held])
    times = np.concatenate([h[1] for h in held]).astype(np.int64)
    order = np.argsort(code, kind="stable")
    first = np.flatnonzero(np.append(True, code[order][1:] != code[order][:-1]))
    size = np.diff(np.append(first, len(code)))
    several = (size > 1) | (np.maximum.reduceat(times[order], first) >= 32_768)
    often = np.add.reduceat(times[order] & 32_767, first) > hot
    flags = np.empty(len(code), np.uint8)
    flags[order] = np.repeat(np.where(several, 1 + often, 0).astype(np.uint8), size)
    parts = np.split(flags, np.cumsum([len(h[0]) for h in held])[:-1])
    return pd.DataFrame({"block": rows["block"], "bucket": rows["bucket"], "flags": [_freeze(p) for p in parts]})


# Surroundings of shared anchors.


def _rows_of(data: np.ndarray, at: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bytes of pieces as rows of one width, filled up with zeros."""
    rows = np.lib.stride_tricks.sliding_window_view(np.append(data, np.zeros(_WIDTH, np.uint8)), _WIDTH)[at]
    rows[np.arange(_WIDTH) >= length[:, None]] = 0
    return rows


def _row_hash(rows: np.ndarray, length: np.ndarray) -> np.ndarray:
    out, powers = np.empty(len(rows), np.uint64), _powers(_BASE, _WIDTH)
    for at in range(0, len(rows), 50_000):
        out[at : at + 50_000] = (_VALUES[rows[at : at + 50_000]] * powers).sum(axis=1, dtype=np.uint64)
    return _mix(out + length.astype(np.uint64))


def _gram_hash(rows: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Hash of the gram at ``offset`` of every row, as ``_anchors`` has it."""
    grams = np.lib.stride_tricks.sliding_window_view(rows, GRAM, axis=1)[np.arange(len(rows)), offset]
    return _evenly(_mix((_VALUES[grams] * _powers(_BASE, GRAM)).sum(axis=1, dtype=np.uint64)))


def _classes(key: np.ndarray, anchor: np.ndarray, length: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number the pieces that are equal in key, place of the anchor and bytes; and a piece of every class."""
    name = _row_hash(rows, length * 256 + anchor)
    while True:
        order = np.lexsort((name, key))
        new = np.append(True, (key[order][1:] != key[order][:-1]) | (name[order][1:] != name[order][:-1]))[: len(order)]
        number = np.empty(len(key), np.int64)
        number[order] = np.cumsum(new) - 1
        example = order[np.flatnonzero(new)]
        of = example[number]
        wrong = (anchor != anchor[of]) | (length != length[of])
        for at in range(0, len(rows), 50_000):
            wrong[at : at + 50_000] |= (rows[at : at + 50_000] != rows[of[at : at + 50_000]]).any(axis=1)
        if not wrong.any():
            return number, example
        name[wrong] += np.uint64(1)  # a collision: these are another class


def _surroundings(batches: Iterator[pa.RecordBatch], bits: int, parts: int, slice_: int) -> Iterator[pa.RecordBatch]:
    """Per block and bucket the distinct surroundings of shared anchors, with the places and documents that have them."""
    for batch in batches:
        for row in range(batch.num_rows):
            data, ends, ids, known = _opened(batch, row)
            gram, at, many, anchor, doc = _anchors(data, ends, known, slice_)
            if not len(gram):
                continue
            _, place = np.unique(gram >> np.uint64(64 - bits), return_inverse=True)
            replies = sorted(batch.column("replies")[row].as_py(), key=lambda r: r["bucket"])
            flag = np.concatenate([_thaw(r["flags"], "u1")[0] for r in replies])[place]
            flag[np.isin(doc, batch.column("copies")[row].as_py() or [])] = 0
            common, hot = flag == 1, np.flatnonzero(flag == 2)
            whose, step = _spread(many[hot])
            each = at[hot][whose] + step
            start = np.concatenate([at[common], each])
            if not len(start):
                continue
            length = np.concatenate([many[common] + LENGTH - 1, np.full(len(each), LENGTH)])
            offset = np.concatenate([anchor[common] - at[common], np.full(len(each), _ALONE)])
            owner = ids[np.concatenate([doc[common], doc[hot][whose]])]
            rows = _rows_of(data, start, length)
            key = np.concatenate([gram[common], _row_hash(rows[common.sum() :], length[common.sum() :])])
            number, _ = _classes(key, offset, length, rows)
            bucket = (key >> np.uint64(64 - parts)).astype(np.int64) if parts else np.zeros(len(key), np.int64)
            # By bucket, then classes by their first place, then places: numbers that grow slowly.
            least = np.full(number.max() + 1, len(data))
            np.minimum.at(least, number, start)
            member = np.lexsort((start, number, least[number], bucket))
            new = np.append(True, number[member][1:] != number[member][:-1])
            example, upto = member[new], np.append(np.flatnonzero(new), len(member))
            cut = np.flatnonzero(np.append(True, bucket[example][1:] != bucket[example][:-1]))
            bucket, blobs = bucket[example], []
            for lo, hi in zip(cut, np.append(cut[1:], len(example)), strict=True):
                mine, held = example[lo:hi], member[upto[lo] : upto[hi]]
                inside = np.arange(_WIDTH) < length[mine][:, None]
                blobs.append(
                    _freeze(length[mine].astype(np.uint8), offset[mine].astype(np.uint8), rows[mine][inside], np.diff(upto[lo : hi + 1]), np.diff(start[held], prepend=0), np.diff(owner[held], prepend=0))
                )
            block = pa.array([batch.column("block")[row].as_py()] * len(cut), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(bucket[cut], pa.int64()), block, pa.array(blobs, pa.binary())], names=["bucket", "block", "pieces"])


# The suffix sort.


def _less(prefixes: Prefixes, text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """-1, 0 or 1 for the suffixes at ``a`` and ``b``, over ``LENGTH`` bytes: a binary search for how far they agree."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), LENGTH)
    while (low < high).any():
        middle = (low + high + 1) >> 1
        agree = prefixes.of(a, middle) == prefixes.of(b, middle)
        low, high = np.where(agree, middle, low), np.where(agree, high, middle - 1)
    ends = low < LENGTH
    return np.where(ends, np.sign(text[a + low * ends].astype(np.int16) - text[b + low * ends].astype(np.int16)), 0)


def _merged(prefixes: Prefixes, text: np.ndarray, group: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Order of the suffixes ``at`` inside each group (``group`` ascending): runs of 1, 2, 4 ... are merged everywhere at once."""
    order = np.arange(len(at))
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1])[: len(group)])
    size = np.diff(np.append(first, len(group)))
    begin, long = np.repeat(first, size), np.repeat(size, size)
    width = 1
    while len(size) and width < size.max():
        open_ = np.flatnonzero(long > width)
        local = open_ - begin[open_]
        run = local // width
        sibling = begin[open_] + (run ^ 1) * width
        end = np.minimum(sibling + width, begin[open_] + long[open_])
        right = run & 1
        low, high = np.minimum(sibling, end), end.copy()
        mine = at[order[open_]]
        while True:
            todo = np.flatnonzero(low < high)
            if not len(todo):
                break
            middle = (low[todo] + high[todo]) >> 1
            sign = _less(prefixes, text, at[order[middle]], mine[todo])
            before = (sign < 0) | ((sign == 0) & (right[todo] == 1))
            low[todo] = np.where(before, middle + 1, low[todo])
            high[todo] = np.where(before, high[todo], middle)
        target = begin[open_] + (run & ~1) * width + local % width + (low - np.minimum(sibling, end))
        moved = order.copy()
        moved[target] = order[open_]
        order = moved
        width *= 2
    return order


def _words(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The ``LENGTH`` bytes from each place on, as big-endian numbers that compare like the bytes."""
    wide = -(-LENGTH // 8) * 8
    rows = np.lib.stride_tricks.sliding_window_view(text, wide)[at]
    rows[:, LENGTH:] = 0
    return rows.view(">u8").astype(np.uint64)


def _steps(text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Comparison, by bytes, of every suffix with the one before it in ``at``: 1, 0, or -1 if the order is wrong."""
    out = np.ones(len(at), np.int8)
    for lo in range(1, len(at), 200_000):
        words = _words(text, at[lo - 1 : lo + 200_000])
        unequal = words[1:] != words[:-1]
        place = np.argmax(unequal, axis=1)
        row = np.arange(len(place))
        later = words[1:][row, place] > words[:-1][row, place]
        out[lo : lo + 200_000] = np.where(unequal.any(axis=1), np.where(later, 1, -1), 0)
    return out


def suffix_runs(text: np.ndarray, group: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A number for every suffix, equal where group and ``LENGTH`` bytes are; ``group`` ascends, ``text`` ends in padding."""
    round_ = 0
    while True:
        order = _merged(Prefixes(text, round_), text, group, at)
        step = _steps(text, at[order])
        apart = np.append(True, group[1:] != group[:-1])[: len(group)]
        if not ((step < 0) & ~apart).any():
            break
        round_ += 1  # hashes collided: again with another base
    number = np.empty(len(at), np.int64)
    number[order] = np.cumsum(apart | (step != 0)) - 1
    return number


def _repeats(rows: pd.DataFrame) -> pd.DataFrame:
    """Per block of a bucket the intervals that an earlier document has as well."""
    held = [_thaw(b, "u1", "u1", "u1", "i8", "i8", "i8") for b in rows["pieces"]]
    source = np.repeat(np.arange(len(held)), [len(h[4]) for h in held])
    length, offset, flat, count = (np.concatenate([h[k] for h in held]) for k in range(4))
    start, owner = (np.concatenate([np.cumsum(h[k]) for h in held]) for k in (4, 5))
    del held
    length, offset = length.astype(np.int64), offset.astype(np.int64)
    text_at, member_at = np.cumsum(length) - length, np.cumsum(count) - count
    key = np.empty(len(length), np.uint64)
    for lo in range(0, len(key), _PIECES):
        part = slice(lo, lo + _PIECES)
        pieces, alone = _rows_of(flat, text_at[part], length[part]), offset[part] == _ALONE
        key[part] = np.where(alone, _row_hash(pieces, length[part]), _gram_hash(pieces, np.where(alone, 0, offset[part])))
    by_key = np.argsort(key, kind="stable")
    sorted_, found, lo = key[by_key], [], 0
    while lo < len(by_key):
        # Some thousand pieces at a time, those of one key together.
        hi = int(np.searchsorted(sorted_, sorted_[min(lo + _PIECES, len(by_key)) - 1], side="right"))
        pick = by_key[lo:hi]
        of, step = _spread(count[pick])
        member = member_at[pick][of] + step
        begin, end, place = _earlier(key[pick], length[pick], offset[pick], _rows_of(flat, text_at[pick], length[pick]), of, start[member], owner[member])
        found.append((source[member][place], begin, end))
        lo = hi
    block, begin, end = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((begin, block))
    block, begin, end = block[order], begin[order], end[order]
    cut = np.flatnonzero(np.append(True, block[1:] != block[:-1]))[: len(block)]
    blobs = [_freeze(_deltas(b), (e - b).astype(np.int16)) for b, e in zip(np.split(begin, cut[1:]), np.split(end, cut[1:]), strict=True)] if len(block) else []
    return pd.DataFrame({"block": rows["block"].to_numpy()[block[cut]] if len(block) else np.zeros(0, np.int64), "gone": blobs})


def _earlier(
    key: np.ndarray, length: np.ndarray, offset: np.ndarray, pieces: np.ndarray, of: np.ndarray, start: np.ndarray, owner: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins, ends and places of the intervals whose windows a smaller document has.

    A place has piece ``of``, begins at ``start`` of its block and belongs to document ``owner``.
    """
    number, example = _classes(key, offset, length, pieces)
    member = number[of]
    first = np.full(len(example), np.iinfo(np.int64).max)
    np.minimum.at(first, member, owner)
    # Windows of the distinct surroundings, each with the smallest document that holds its class.
    windows = length[example] - LENGTH + 1
    base = np.cumsum(windows) - windows
    piece, at = _spread(windows)
    earliest = first[piece]
    _, inverse, kinds = np.unique(key[example], return_inverse=True, return_counts=True)
    several = np.flatnonzero(kinds[inverse][piece] > 1)
    if len(several):
        texts = np.append(pieces[example].reshape(-1), np.zeros(64, np.uint8))
        group = inverse[piece[several]] * (_REACH + 1) + (offset[example][piece[several]] - at[several])
        by_group = np.argsort(group, kind="stable")
        several, group = several[by_group], group[by_group]
        run = suffix_runs(texts, group, piece[several] * _WIDTH + at[several])
        least = np.full(run.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, run, earliest[several])
        earliest[several] = least[run]
    # Places whose windows an earlier document has: runs of such windows are intervals.
    late = np.flatnonzero(np.minimum.reduceat(earliest, base)[member] < owner)
    who, step = _spread(windows[member[late]])
    gone = earliest[base[member[late]][who] + step] < owner[late][who]
    edge = np.append(True, who[1:] != who[:-1])[: len(who)]
    before = np.append(False, gone[:-1])[: len(gone)] & ~edge
    after = np.append(gone[1:], False)[: len(gone)] & ~np.append(edge[1:], True)[: len(edge)]
    lo, hi = np.flatnonzero(gone & ~before), np.flatnonzero(gone & ~after)
    return start[late][who[lo]] + step[lo], start[late][who[hi]] + step[hi] + LENGTH, late[who[lo]]


# What is left.

_LEFT = "doc_id bigint, n_bytes bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept binary, kept_sha256 string"


def _remaining(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            data, ends, ids, known = _opened(batch, row)
            change = np.zeros(len(data) + 1, np.int32)
            for blob in batch.column("gone")[row].as_py() or []:
                begin, size = _thaw(blob, "i8", "i2")
                begin = np.cumsum(begin)
                np.add.at(change, begin, 1)
                np.add.at(change, begin + size, -1)
            begins = np.append(0, ends[:-1])
            whole = np.array(batch.column("copies")[row].as_py() or [], np.int64)
            np.add.at(change, begins[whole], 1)
            np.add.at(change, ends[whole], -1)
            gone = np.cumsum(change)[:-1] > 0
            fresh = gone.copy()
            fresh[1:] &= ~gone[:-1]
            fresh[begins[begins < len(data)]] |= gone[begins[begins < len(data)]]
            last = gone.copy()
            last[:-1] &= ~gone[1:]
            stops = ends[ends > 0] - 1
            last[stops] |= gone[stops]
            lo, hi = np.flatnonzero(fresh), np.flatnonzero(last) + 1
            doc = np.searchsorted(ends, lo, side="right")
            spans = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(doc, np.arange(len(ends) + 1)).astype(np.int32)), pa.StructArray.from_arrays([pa.array(lo - begins[doc]), pa.array(hi - begins[doc])], names=["start", "end"])
            )
            kept = [data[b:e][~gone[b:e]].tobytes() for b, e in zip(begins, ends, strict=True)]
            sizes = ends - begins
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64(), mask=~known),
                    pa.array(sizes, pa.int64()),
                    pa.array(sizes - np.array([len(k) for k in kept], np.int64), pa.int64()),
                    spans,
                    pa.array(kept, pa.binary()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "spans", "kept", "kept_sha256"],
            )


def _power(wanted: float) -> int:
    """Bits of the smallest power of two that reaches ``wanted``."""
    return max(0, int(np.ceil(np.log2(max(wanted, 1)))))


def remove_repeats(docs: DataFrame, sizes: Sizes = Sizes()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): ``doc_id``, ``n_bytes``, ``n_removed``, ``spans``, ``kept``, ``kept_sha256``.

    A byte goes if a string of 50 bytes around it also starts in a row with a smaller id, both taken from the input. ``spans``
    are the maximal removed runs, in bytes, and ``kept`` the bytes that remain, which may begin or end inside a
    character. A null text is empty. Texts below 50 bytes stay whole. A row with a null id stays whole and removes nothing;
    rows that share an id don't remove from each other. Other columns are not read; an empty table gives none.
    """
    rows = docs.select(docs["doc_id"].cast("long"), docs["text"]).mapInArrow(lambda b: _packing(b, sizes.block), _BLOCKS)
    blocks = stage(rows.withColumn("block", F.monotonically_increasing_id()), "suffix-blocks")
    total = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, b: a + b)).alias("n")).first()["n"] or 0
    # So many bits that hardly any anchor shares its code by chance, however large the corpus is.
    parts = _power(total / sizes.bucket)
    bits = min(62, max(_power(total) + 2, parts + 8))
    codes = blocks.mapInArrow(lambda b: _coded(b, bits, parts, sizes.slice), "bucket bigint, block bigint, codes binary")
    shared = codes.groupBy("bucket").applyInPandas(lambda rows: _shared(rows, sizes.hot), "block bigint, bucket bigint, flags binary")
    replies = shared.groupBy("block").agg(F.collect_list(F.struct("bucket", "flags")).alias("replies"))
    copies = stage(copies_in(blocks), "suffix-copies")
    pieces = blocks.join(replies, "block").join(copies, "block", "left").mapInArrow(lambda b: _surroundings(b, bits, parts, sizes.slice), "bucket bigint, block bigint, pieces binary")
    gone = pieces.groupBy("bucket").applyInPandas(_repeats, "block bigint, gone binary").groupBy("block").agg(F.collect_list("gone").alias("gone"))
    return blocks.join(gone, "block", "left").join(copies, "block", "left").mapInArrow(_remaining, _LEFT)

"""Token ids in files of adaptively coded, checksummed blocks.

A block is a run of ids, coded with a model that starts anew. Two tables remember which id last followed the
last two ids (order 2) and the last one (order 1). The better of them predicts the next id; whether it is right
is coded with a probability mixed from what orders 2, 1 and 0 say, and the shares of the mixture follow how well
each of them did. An id that was not predicted is coded with order-0 counts. All arithmetic is in whole numbers,
so every machine decodes what another one coded.

Blocks do not depend on each other. A block is cut into lanes that are coded side by side, one numpy element
each, with one model: each step codes the next id of every lane, and then the model learns from all of them.
"""

from __future__ import annotations

import math
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.session import scratch_path

MAGIC = b"IDCM2\n"
LANES = 8192  # at most, in a block
LANE = 128  # ids that a lane has at least, in a block of so many
BLOCK = 1 << 21  # ids at most
SEGMENT = BLOCK // 2  # ids after which a file row ends, at the next end of a document
ROWS_PER_FILE = 6_000  # documents, as long as that gives fewer files than the next number
MOST_FILES = 20_000

_LOW = np.uint64((1 << 32) - 1)
_FULL = np.uint64(1 << 32)
_16, _32 = np.uint64(16), np.uint64(32)
_STEP = 32  # what one occurrence adds to a count
_MOST = 1 << 22  # counts are halved when they add up to more; the coder's parts stay above zero
_T2_BITS = 18
_LEVELS = np.array([min(k.bit_length(), 7) for k in range(65)])  # by how many 2048ths of all counts an id has


class _Model:
    """What the lanes of a block have in common. Ids are whole numbers below 65,536.

    Entries of the tables are ids times four, plus how sure they are; 0 is none. Where lanes of one step meet
    in an entry, the last lane's stays.
    """

    def __init__(self, lanes: int) -> None:
        self.prev1 = np.zeros(lanes, np.int64)
        self.prev2 = np.zeros(lanes, np.int64)
        self.t1 = np.zeros(1 << 16, np.int64)
        self.t2 = np.zeros(1 << _T2_BITS, np.int64)
        self.counts = np.ones(1 << 16, np.int64)
        # How often a guess was right or not, by what orders 2, 1 and 0 say of it: eight cases each.
        self.right = np.full((3, 8), 1, np.int64)
        self.asked = np.full((3, 8), 2, np.int64)
        self.shares = np.full((3, 8), 1 << 14, np.int64)  # of each order, in each case of order 2
        self.steps = 0
        self.seen = np.zeros((8, 8, 8, 2), np.int64)
        self.missed: list[np.ndarray] = []
        self._refresh()

    def _refresh(self) -> None:
        self.total = int(self.counts.sum())
        self.starts = self.often = None
        self.p = (self.right << 16) // self.asked
        parts = self.shares[0] * self.p[0], self.shares[1, :, None] * self.p[1], self.shares[2, :, None] * self.p[2]
        mixed = (parts[0][:, None, None] + parts[1][:, :, None] + parts[2][:, None, :]) // self.shares.sum(0)[:, None, None]
        self.mixed = np.clip(mixed, 256, 65536 - 256).astype(np.uint64).reshape(-1)

    def intervals(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of ids in the order-0 counts."""
        if self.starts is None:
            self.starts = np.cumsum(self.counts) - self.counts
        return self.starts.take(ids).astype(np.uint64), self.counts.take(ids).astype(np.uint64)

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids whose intervals hold these values, and the intervals; ids between those counted are 1 wide."""
        if self.often is None:
            often = np.flatnonzero(self.counts > 1)
            widths = np.append(self.counts[often], 1)
            self.often = np.append(often, 1 << 16), widths, np.cumsum(widths - 1) - (widths - 1)
            self.often += (self.often[2] + self.often[0],)
            self.upto = self.often[3] + widths
        at = np.searchsorted(self.upto, values, "right")
        start = self.often[3].take(at)
        short = np.maximum(start - values, 0)
        width = np.where(short > 0, 1, self.often[1].take(at))
        return self.often[0].take(at) - short, (start - short).astype(np.uint64), width.astype(np.uint64)

    def predict(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The predicted id of the first ``n`` lanes, and how likely it is, of 65,536."""
        self.at1 = self.prev1[:n]
        self.at2 = ((self.at1 * 2654435761 + self.prev2[:n] * 40503 * 65537) >> 12) & ((1 << _T2_BITS) - 1)
        self.s1, self.s2 = self.t1.take(self.at1), self.t2.take(self.at2)
        known = self.s2 > 0
        guess = np.where(known, self.s2, self.s1) >> 2
        case2 = (self.s2 & 3) + 4 * known
        case1 = (self.s1 & 3) + 4 * ((self.s1 >> 2) == guess)
        case0 = _LEVELS.take(np.minimum(self.counts.take(guess) * 2048 // self.total, 64))
        self.case = case2 * 64 + case1 * 8 + case0
        return guess, self.mixed.take(self.case)

    def learn(self, n: int, ids: np.ndarray, hit: np.ndarray) -> None:
        self.seen += np.bincount(self.case * 2 + hit, minlength=1024).reshape(8, 8, 8, 2)
        fresh = ids * 4 + 1
        for table, at, old in ((self.t1, self.at1, self.s1), (self.t2, self.at2, self.s2)):
            sure = old & 3
            # A sure entry loses some before it is replaced.
            table[at] = np.where((old >> 2) == ids, old + (sure < 3), np.where(sure > 1, old - 1, fresh))
        self.prev2[:n] = self.prev1[:n]
        self.prev1[:n] = ids
        # The order-0 counts see the ids that were not predicted.
        self.missed.append(ids[~hit])
        self.steps += 1
        if self.steps <= 16 or self.steps % 4 == 0:
            self._sum_up()

    def _sum_up(self) -> None:
        """What the last steps, one or four, say of the counts, the cases and the shares."""
        for k, axes in enumerate(((1, 2), (0, 2), (0, 1))):
            of_case = self.seen.sum(axes)
            self.right[k] += of_case[:, 1]
            self.asked[k] += of_case.sum(1)
        self._judge(self.seen)
        self.seen = np.zeros((8, 8, 8, 2), np.int64)
        missed = np.concatenate(self.missed)
        np.add.at(self.counts, missed, _STEP)
        if self.total + len(missed) * _STEP > _MOST:
            self.counts = (self.counts + 1) >> 1
        self.missed = []
        self._refresh()

    def _judge(self, seen: np.ndarray) -> None:
        """Multiply each order's share by the mean probability that it gave to what happened."""
        asked = seen.sum((1, 2, 3))
        met = asked > 0
        good = np.full((3, 8), 1 << 16, np.int64)
        for k, by_case in enumerate((seen.sum((1, 2))[:, None], seen.sum(2), seen.sum(1))):
            p = self.p[0][:, None] if k == 0 else self.p[k]
            got = (by_case[..., 1] * p + by_case[..., 0] * (65536 - p)).sum(1)
            good[k, met] = got[met] // asked[met]
        won = self.shares * good
        self.shares = (won << 14) // np.maximum(won.sum(0), 1) + 64


def _lanes(n: int) -> tuple[int, int]:
    """How many lanes a block of ``n`` ids has, and how many ids all of them but the last."""
    steps = max(1, math.ceil(n / max(1, min(LANES, n // LANE))))
    return math.ceil(n / steps), steps


def encode_block(ids: np.ndarray) -> bytes:
    """The coded bytes of at most ``BLOCK`` ids, each below 65,536.

    A range coder per lane: 64 bits, 32 of which go out when the range falls below 2^32. The words of all
    lanes follow their numbers, lane after lane.
    """
    lanes, steps = _lanes(len(ids))
    if not lanes:
        return b""
    table = np.zeros(lanes * steps, np.int64)
    table[: len(ids)] = ids
    table = np.ascontiguousarray(table.reshape(lanes, steps).T)
    model = _Model(lanes)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    out, pos = np.zeros((lanes, steps + 1), np.uint32), np.zeros(lanes, np.int64)
    last = len(ids) - (lanes - 1) * steps
    for t in range(steps):
        n = lanes - (t >= last)
        now = table[t, :n]
        guess, p = model.predict(n)
        hit = guess == now
        bound = (size[:n] >> _16) * p
        part = (size[:n] - bound) // np.uint64(model.total)
        start, width = model.intervals(now)
        low[:n] += np.where(hit, np.uint64(0), bound + part * start)
        size[:n] = np.where(hit, bound, part * width)
        due = np.flatnonzero(size[:n] < _FULL)
        if len(due):
            at = low[due]
            out[due, pos[due]] = at >> _32
            pos[due] += 1
            size[due] = np.minimum(size[due], _FULL - (at & _LOW)) << _32
            low[due] = at << _32
        model.learn(n, now, hit)
    # One more word names a number within what is left; the words after it count as 0.
    out[np.arange(lanes), pos] = (low + _LOW) >> _32
    words = out[np.arange(steps + 1) <= pos[:, None]]
    return (pos + 1).astype("<u2").tobytes() + words.astype("<u4").tobytes()


def decode_block(data: bytes, n_ids: int) -> np.ndarray:
    """The ids of a coded block; words that do not add up are an error."""
    lanes, steps = _lanes(n_ids)
    words = np.frombuffer(data[: 2 * lanes], "<u2").astype(np.int64)
    if n_ids > BLOCK or len(words) != lanes or len(data) != 2 * lanes + 4 * words.sum() or words.max(initial=0) > steps + 1:
        raise ValueError("a block of coded ids is damaged")
    if not lanes:
        return np.zeros(0, np.int64)
    coded = np.zeros((lanes, steps + 3), np.uint64)
    coded[np.arange(steps + 3) < words[:, None]] = np.frombuffer(data, "<u4", offset=2 * lanes)
    model = _Model(lanes)
    low, size = np.zeros(lanes, np.uint64), np.full(lanes, (1 << 64) - 1, np.uint64)
    # How far the coded number lies beyond ``low``.
    far, pos = (coded[:, 0] << _32) | coded[:, 1], np.full(lanes, 2, np.int64)
    table = np.zeros((steps, lanes), np.int64)
    last = n_ids - (lanes - 1) * steps
    for t in range(steps):
        n = lanes - (t >= last)
        now, p = model.predict(n)
        bound = (size[:n] >> _16) * p
        rest = size[:n] - bound
        hit = far[:n] < bound
        size[:n] = np.where(hit, bound, rest)
        missed = np.flatnonzero(~hit)
        if len(missed):
            part = rest[missed] // np.uint64(model.total)
            beyond = far[missed] - bound[missed]
            found, start, width = model.find(np.minimum(beyond // part, np.uint64(model.total - 1)).astype(np.int64))
            start *= part
            far[missed] = beyond - start
            low[missed] += bound[missed] + start
            size[missed] = part * width
            now[missed] = found
        table[t, :n] = now
        due = np.flatnonzero(size[:n] < _FULL)
        if len(due):
            at = low[due]
            size[due] = np.minimum(size[due], _FULL - (at & _LOW)) << _32
            low[due] = at << _32
            far[due] = (far[due] << _32) | coded[due, pos[due]]
            pos[due] += 1
        model.learn(n, now, hit)
    return table.T.reshape(-1)[:n_ids]


def _checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def pack(segments: list[np.ndarray]) -> list[bytes]:
    """One payload per segment: magic, number of blocks, (ids, bytes, checksum) of each, then their bytes."""
    out = []
    for ids in segments:
        blocks = np.array_split(ids, math.ceil(len(ids) / BLOCK)) if len(ids) else []
        streams = [encode_block(b) for b in blocks]
        head = [struct.pack("<III", len(b), len(s), _checksum(b)) for b, s in zip(blocks, streams, strict=True)]
        out.append(b"".join([MAGIC, struct.pack("<I", len(blocks)), *head, *streams]))
    return out


def unpack(payloads: list[bytes]) -> list[np.ndarray]:
    """The ids of each payload; a wrong magic, length or checksum is an error."""
    out = []
    for data in payloads:
        if data[: len(MAGIC)] != MAGIC:
            raise ValueError("not a file of coded ids")
        (n,) = struct.unpack_from("<I", data, len(MAGIC))
        at = len(MAGIC) + 4
        head = [struct.unpack_from("<III", data, at + 12 * k) for k in range(n)]
        at += 12 * n
        if at + sum(size for _, size, _ in head) != len(data):
            raise ValueError("coded ids are cut short or too long")
        blocks = []
        for n_ids, size, checksum in head:
            blocks.append(decode_block(data[at : at + size], n_ids))
            at += size
            if _checksum(blocks[-1]) != checksum:
                raise ValueError("a block of coded ids is damaged")
        out.append(np.concatenate(blocks) if blocks else np.zeros(0, np.int64))
    return out


class WordIds:
    """Ids of whole texts by a word tokenizer that drops white space; pieces of them are remembered."""

    REMEMBERED = 500_000  # pieces and parts; as many again that were used before these
    CHARS = 4_000_000  # of text at a time, but whole texts

    # Between a letter and ASCII punctuation or a digit a word always ends, and a new one starts after a digit or a
    # mark, unless an apostrophe could open a suffix. The letters are those that stay one letter in lower case.
    _PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-@\[-`{-~]*)").fullmatch
    _ENDS = re.compile(r"(?<=[A-Za-zÀ-ÖØ-öø-ÿ])(?=[!-@\[-`{-~])|(?<=[!-&(-@\[-`{-~])(?=[A-Za-zÀ-ÖØ-öø-ÿ])")

    _LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
    _WORD = re.compile(f"[{_LETTERS}]+").fullmatch

    def __init__(self, data: bytes) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_buffer(data)
        # Words of lower-case letters only need the library's merges, if its normalizers and splits leave them as they are.
        self.model = self.tokenizer.model
        as_bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {ord(c): as_bytes.pre_tokenize_str(c)[0][0] for c in self._LETTERS}
        samples = [*self._LETTERS, self._LETTERS, self._LETTERS[::-1]]
        self.merges_do = [self._merged(w) for w in samples] == self._each(samples)
        # Added tokens are found in the raw text: pieces that hold one stay whole.
        self.whole = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.zero = self.tokenizer.encode("0", add_special_tokens=False).ids
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    def encode(self, texts: pa.StringArray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, ``end_id`` after each text's own, and how many each text has with it.

        Pieces are cut at ASCII white space, which ends a word in this kind of tokenizer whatever stands around
        it. Pieces not yet known are cut further, and parts not yet known go to the library.
        """
        lists = pc.ascii_split_whitespace(texts)
        pieces = lists.flatten().dictionary_encode()
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        coded = list(map(self.known.get, distinct))
        missing = [k for k, c in enumerate(coded) if c is None]
        for k, c in zip(missing, self._learn([distinct[k] for k in missing]), strict=True):
            coded[k] = c
        coded.append(struct.pack("<I", end_id))
        pool, sizes = np.frombuffer(b"".join(coded), "<u4"), np.array([len(c) // 4 for c in coded])
        starts = np.cumsum(sizes) - sizes
        text_ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64))
        picked = np.insert(pieces.indices.to_numpy().astype(np.int64), text_ends, len(coded) - 1)
        n = sizes[picked]
        ends = np.cumsum(n)
        ids = pool[np.repeat(starts[picked] - (ends - n), n) + np.arange(int(n.sum()))]
        return ids, np.diff(ends[text_ends + np.arange(len(texts))], prepend=0)

    def _parts(self, piece: str) -> list[str]:
        plain = self._PLAIN(piece)
        if plain:
            return [plain[1].lower(), plain[2]]
        return [piece] if any(token in piece for token in self.whole) else self._ENDS.split(piece)

    def _learn(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces that are not known."""
        if len(self.known) > self.REMEMBERED:
            self.before, self.known = self.known, {}
        known = self.known
        cut = {p: self._parts(p) for p in self._missing(pieces)}
        new = self._missing({part for parts in cut.values() for part in parts})
        for lo in range(0, len(new), 20_000):
            some = new[lo : lo + 20_000]
            known.update(zip(some, self._of_library(some), strict=True))
        for p, parts in cut.items():
            known[p] = b"".join([known[part] for part in parts])
        return [known[p] for p in pieces]

    def _missing(self, pieces: Iterable[str]) -> list[str]:
        """Those of the pieces that are not known; what was known before is kept for longer."""
        known, before = self.known, self.before
        out = [p for p in pieces if p not in known]
        known.update((p, before[p]) for p in out if p in before)
        return [p for p in out if p not in before]

    def _of_library(self, parts: list[str]) -> list[bytes]:
        """Ids of each part. Parts without zeros are joined by zeros, which are words of their own."""
        found = {p: self._merged(p) for p in parts if self._WORD(p)} if self.merges_do else {}
        alone = [p for p in parts if "0" in p or any(token in p for token in self.whole)]
        found.update(zip(alone, self._each(alone), strict=True))
        rest = [p for p in parts if p not in found]
        groups = [rest[k : k + 50] for k in range(0, len(rest), 50)]
        for group, ids in zip(groups, self._each([" 0 ".join(g) for g in groups]), strict=True):
            codes = np.frombuffer(ids, "<u4")
            cuts = (np.flatnonzero(codes == self.zero[0]) * 4).tolist() if len(self.zero) == 1 else []
            if len(cuts) == len(group) - 1:
                found.update((p, ids[lo:hi]) for p, lo, hi in zip(group, [0, *(c + 4 for c in cuts)], [*cuts, len(ids)], strict=True))
            else:
                found.update(zip(group, self._each(group), strict=True))
        return [found[p] for p in parts]

    def _merged(self, word: str) -> bytes:
        tokens = self.model.tokenize(word.translate(self.letters))
        return struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])

    def _each(self, texts: list[str]) -> list[bytes]:
        return [struct.pack(f"<{len(c)}I", *c.ids) for c in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


_TOKENIZERS: dict[int, WordIds] = {}


def _tokenizer(data: bytes) -> WordIds:
    key = hash(data)
    if key not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[key] = WordIds(data)
    return _TOKENIZERS[key]


def write_ids(docs: DataFrame, tokenizer_path: str, end_id: int, path: str, id_column: str = "doc_id", text_column: str = "text", rows_per_file: int = ROWS_PER_FILE) -> None:
    """Encode every text, append ``end_id``, and write the ids in ascending order of the id column.

    The table at ``path`` has a row per segment of a file: ``part`` and ``segment`` number in order of the
    ids, ``before`` and ``n_ids``, the documents' ids and lengths, and the payload. Documents are never
    cut apart between segments. Null texts are empty, null ids come first, rows with equal ids stand in
    the order of their texts; other columns are not looked at. A task that is run again writes the same.
    """
    spark = docs.sparkSession
    with open(tokenizer_path, "rb") as f:
        model = spark.sparkContext.broadcast(f.read())
    parts = max(1, min(MOST_FILES, math.ceil(docs.count() / rows_per_file)))
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _tokenizer(model.value)
        part = TaskContext.get().partitionId()
        segment = before = size = 0
        keys: list = []
        lengths: list[int] = []
        held: list[np.ndarray] = []

        def close() -> pa.RecordBatch:
            nonlocal segment, before, size, keys, lengths, held
            (payload,) = pack([np.concatenate(held).astype(np.int64)])
            row = {"part": [part], "segment": [segment], "before": [before], "n_ids": [size], "ids": [keys], "lengths": [lengths], "payload": [payload]}
            segment, before, size, keys, lengths, held = segment + 1, before + size, 0, [], [], []
            return pa.RecordBatch.from_pydict(row, schema=schema)

        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1)
            chars = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < len(names):
                stop = int(np.searchsorted(chars, (chars[at - 1] if at else 0) + words.CHARS)) + 1
                ids, counts = words.encode(texts[at:stop], end_id)
                first = 0
                for name, n in zip(names[at:stop], counts.tolist(), strict=True):
                    keys.append(name)
                    lengths.append(n)
                    held.append(ids[first : first + n])
                    first += n
                    size += n
                    if size >= SEGMENT:
                        yield close()
                at = stop
        if keys:
            yield close()

    schema = pa.schema(
        [("part", pa.int32()), ("segment", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()), ("ids", pa.list_(_arrow(kind))), ("lengths", pa.list_(pa.int64())), ("payload", pa.binary())]
    )
    rows = docs.select(docs[id_column].alias("key"), F.coalesce(docs[text_column], F.lit("")).alias("text"))
    ordered = rows.repartitionByRange(parts, "key", F.substring("text", 1, 64)) if parts > 1 else rows.coalesce(1)
    coded = ordered.sortWithinPartitions("key", "text").mapInArrow(run, f"part int, segment int, before bigint, n_ids bigint, ids array<{kind}>, lengths array<bigint>, payload binary")
    coded.write.parquet(path)


def _arrow(kind: str) -> pa.DataType:
    return {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind]


def read_ids(spark: SparkSession, path: str, id_column: str = "doc_id") -> DataFrame:
    """One row per document: the id column, ``start``, ``n_tokens`` and ``tokens`` (little-endian unsigned 32-bit).

    ``start`` counts the ids of all documents before. Damaged files raise an error.
    """
    table = spark.read.parquet(path)
    totals = table.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()  # a row per file
    first, starts = 0, []
    for r in totals:
        starts.append((r["part"], first))
        first += r["n"]
    offsets = spark.createDataFrame(starts, "part int, first bigint")
    kind = dict(table.dtypes)["ids"][6:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                (ids,) = unpack([batch.column(2)[k].as_py()])
                lengths = batch.column(1)[k].values.to_numpy()
                ends = np.cumsum(lengths)
                raw = ids.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[k].values,
                        pa.array(ends - lengths + batch.column(3)[k].as_py()),
                        pa.array(lengths),
                        pa.array([raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)], pa.binary()),
                    ],
                    names=["key", "start", "n_tokens", "tokens"],
                )

    # One offset per file: as many rows as files.
    placed = table.join(F.broadcast(offsets), "part").select("ids", "lengths", "payload", (F.col("before") + F.col("first")).alias("start"))
    return placed.mapInArrow(run, f"key {kind}, start bigint, n_tokens bigint, tokens binary").withColumnRenamed("key", id_column)


def files_folder(spark: SparkSession) -> str:
    """A new folder for such files under the folder that the cluster shares."""
    return scratch_path(spark, "coded-ids")

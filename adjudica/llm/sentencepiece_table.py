"""SentencePiece merge-type encoding with a prefix table, and decoding.

Every prefix of a text has one encoding under merging, hence one last token. The table keeps that token
per prefix: an automaton lists the pieces that end at a character, and the piece is the last token if its
predecessor (the last token of the prefix before it) could have stood left of it through all merges. The
ids are then recovered backwards from the end of the text.

Texts are cut where no piece of the vocabulary can reach across: before a run of word-start marks and
around characters of no piece. Each cut is encoded once and remembered, up to a bound.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

MARK = "▁"
REMEMBERED = 400_000  # cuts a worker remembers before it starts anew; bounds its memory, not the result
_ATOM = 1 << 40  # rank of what no merge has made


class PrefixTable:
    """Encoder and decoder for one merge-type model, given as the bytes of its file."""

    def __init__(self, model: bytes) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        size = sp.get_piece_size()
        normal = [i for i in range(size) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.text = {i: sp.id_to_piece(i) for i in normal}
        self.id = {p: i for i, p in self.text.items()}
        self.byte_id = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(size) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        # Equal scores give equal ranks: among those the leftmost pair merges first.
        order = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in normal}, reverse=True))}
        self.rank = {i: order[sp.get_score(i)] for i in normal}
        self.left: dict[int, int] = {}
        self.right: dict[int, int] = {}
        self.atoms: dict[str, int] = {}
        for i, p in self.text.items():
            if len(p) == 1:
                self.atoms[p] = i
        # A character that occurs only inside longer pieces is an atom without an id of its own.
        for p in self.text.values():
            for c in p:
                self.atoms.setdefault(c, -2 - len(self.atoms))
        self.string = {**self.text, **{i: c for c, i in self.atoms.items()}}
        self.automaton = ahocorasick.Automaton()
        for i, p in self.text.items():
            if len(p) > 1 and not self._split(i):
                continue  # merging never makes this piece from its own characters
            self.automaton.add_word(p, (len(p), i))
        for c, i in self.atoms.items():
            if i < 0:
                self.automaton.add_word(c, (1, i))
        self.automaton.make_automaton()
        joined = {c for p in self.text.values() if len(p) > 1 for c in p}
        if any(MARK in p.lstrip(MARK) for p in self.text.values()):
            raise ValueError("a piece holds a word-start mark after another character")
        barrier = "\n" if "\n" not in joined else ""
        self.cut = re.compile(f"{barrier}{'|' if barrier else ''}{MARK}*[^{MARK}{barrier}]+|{MARK}+")
        self.pairs: dict[tuple[int, int], bool] = {}
        self.barrier = barrier
        self.known = _Known(self)

    def _split(self, piece: int) -> bool:
        """Find the last merge that makes a piece; false if merging its characters makes something else."""
        parts = [self.atoms[c] for c in self.text[piece]]
        made = (0, 0)
        while len(parts) > 1:
            best, at, new = _ATOM, -1, -1
            for k in range(len(parts) - 1):
                joined = self.id.get(self.string[parts[k]] + self.string[parts[k + 1]])
                if joined is not None and self.rank[joined] < best:
                    best, at, new = self.rank[joined], k, joined
            if at < 0:
                return False
            made = (parts[at], parts[at + 1])
            parts[at : at + 2] = [new]
        self.left[piece], self.right[piece] = made
        return True

    def compatible(self, a: int, b: int) -> bool:
        """Whether tokens ``a`` and ``b`` stay side by side when their joined text is merged.

        Both are taken apart in the reverse order of their merges; if the parts that then touch could have
        merged before the merge just undone, the two tokens never come about.
        """
        known = self.pairs.get((a, b))
        if known is not None:
            return known
        key, limit, result = (a, b), _ATOM, True
        while True:
            joined = self.id.get(self.string[a] + self.string[b])
            if joined is not None and self.rank[joined] < limit:
                result = False
                break
            ra = self.rank[a] if a in self.left else -1
            rb = self.rank[b] if b in self.left else -1
            if ra < 0 and rb < 0:
                break
            if ra > rb:  # of equal ranks the left one merged first, so the right one is undone first
                limit, a = ra, self.right[a]
            else:
                limit, b = rb + 1, self.left[b]
        if len(self.pairs) >= 4 * REMEMBERED:
            self.pairs.clear()
        self.pairs[key] = result
        return result

    def encode_cut(self, cut: str) -> list[int]:
        """The ids of one cut: fill the prefix table, then walk it backwards."""
        n = len(cut)
        last = [0] * (n + 1)
        filled = [False] * (n + 1)
        filled[0] = True
        pairs, atoms = self.pairs.get, self.atoms
        for end, (length, piece) in self.automaton.iter(cut):
            end += 1
            if filled[end]:
                continue
            start = end - length
            # A character of no piece is bytes in the result, and nothing merges across it.
            while not filled[start] and start and cut[start - 1] not in atoms:
                back = start
                while back and not filled[back] and cut[back - 1] not in atoms:
                    back -= 1
                for k in range(back + 1, start + 1):
                    filled[k], last[k] = True, -1
            if filled[start]:
                before = last[start]
                fits = start == 0 or before == -1 or pairs((before, piece))
                if fits or fits is None and self.compatible(before, piece):
                    filled[end], last[end] = True, piece
        ids: list[int] = []
        at = n
        while at:
            token = last[at] if filled[at] else -1
            if token < 0:
                ids.extend(self.byte_id[b] for b in reversed(cut[at - 1].encode("utf-8")))
                at -= 1
            else:
                ids.append(token)
                at -= len(self.text[token])
        ids.reverse()
        return ids

    def encode_piece(self, piece: str) -> tuple[bytes, str]:
        """Ids and decoded text of what stands between two marks, cut by cut; the mark before it comes with it unless a barrier does."""
        if self.barrier and piece.startswith(self.barrier):
            cuts = [c for c in (self.barrier, piece[len(self.barrier) :]) if c]
        else:
            cuts = [MARK + piece]
        ids = [i for c in cuts for i in self.encode_cut(c)]
        return _packed(ids), self._text_of(ids)

    def _text_of(self, ids: list[int]) -> str:
        try:
            return "".join([self.text[i] for i in ids]).replace(MARK, " ")
        except KeyError:  # bytes among them
            pass
        out: list[str] = []
        held = bytearray()
        for i in ids:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            if held:
                out.append(held.decode("utf-8", errors="replace"))
                held.clear()
            out.append(self.text[i])
        out.append(held.decode("utf-8", errors="replace"))
        return "".join(out).replace(MARK, " ")

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        return np.frombuffer(self.encode_decode(text)[0], dtype="<i4").tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of ids; the space put before every text is taken off again."""
        text = self._text_of(ids)
        return text[1:] if text.startswith(" ") and ids and ids[0] not in self.byte_of else text

    def encode_decode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian 32-bit integers, and the text decoded from them.

        A cut begins with a piece that is no byte, or is made of whole characters, so the decoded cuts
        put one after the other are the decoded whole.
        """
        if not text:
            return b"", ""
        if MARK in text or "  " in text or text[0] == " ":  # several marks in a row belong to one cut
            entries = self._cuts(MARK + text.replace(" ", MARK))
        else:
            # A barrier goes with what follows it, so one plain split finds all pieces.
            entries = list(map(self.known.__getitem__, (text.replace(self.barrier, " " + self.barrier) if self.barrier else text).split(" ")))
        return b"".join(map(_IDS, entries)), "".join(map(_TEXT, entries))[1:]

    def _cuts(self, marked: str) -> list[tuple[bytes, str]]:
        """The entries of a text cut by pattern; those that begin with one mark, or with a barrier, are pieces."""
        out, known = [], self.known
        for cut in self.cut.findall(marked):
            if cut == self.barrier:
                out.append(known[cut])
            elif cut[0] == MARK and cut[1:2] != MARK:
                out.append(known[cut[1:]])
            else:
                ids = self.encode_cut(cut)
                out.append((_packed(ids), self._text_of(ids)))
        return out


class _Known(dict):
    """Ids and decoded text by piece, made when first asked for; pieces up to 64 characters are kept, up to a bound."""

    def __init__(self, table: PrefixTable) -> None:
        super().__init__()
        self.table = table

    def __missing__(self, piece: str) -> tuple[bytes, str]:
        entry = self.table.encode_piece(piece)
        if len(self) >= REMEMBERED:
            self.clear()
        if len(piece) < 64:
            self[piece] = entry
        return entry


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}i", *ids)


_IDS, _TEXT = itemgetter(0), itemgetter(1)


_TABLE: dict[int, PrefixTable] = {}


def prefix_table(model: bytes) -> PrefixTable:
    """The table of a model, built once per Python worker."""
    key = hash(model)
    if key not in _TABLE:
        _TABLE.clear()
        _TABLE[key] = PrefixTable(model)
    return _TABLE[key]


def encode_decode(docs: DataFrame, model_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id column, ``ids`` array<int> and ``decoded`` string.

    A null text counts as empty and gives no ids and an empty text. Repeated rows give repeated rows; other
    columns are not looked at, whatever their names. The model file is read on the driver (half a megabyte,
    fixed) and sent to the workers.
    """
    with open(model_path, "rb") as f:
        model = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = prefix_table(model.value)
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            at, held, size = 0, [], 0
            for k in range(batch.num_rows):
                ids, decoded = table.encode_decode(texts[k].as_py() or "")
                held.append((ids, decoded))
                size += len(ids) + len(decoded)
                if size > 16_000_000 or k == batch.num_rows - 1:
                    offsets = np.cumsum([0] + [len(i) // 4 for i, _ in held]).astype("int32")
                    values = pa.array(np.frombuffer(b"".join(i for i, _ in held), dtype="<i4"))
                    yield pa.RecordBatch.from_arrays(
                        [keys.slice(at, len(held)), pa.ListArray.from_arrays(pa.array(offsets), values), pa.array([d for _, d in held], pa.string())],
                        names=["key", "ids", "decoded"],
                    )
                    at, held, size = k + 1, [], 0

    kind = docs.schema[id_column].dataType.simpleString()
    out = docs.select(docs[id_column].alias("key"), docs[text_column].alias("text")).mapInArrow(run, f"key {kind}, ids array<int>, decoded string")
    return out.withColumnRenamed("key", id_column)

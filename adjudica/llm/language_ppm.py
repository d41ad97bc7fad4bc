"""Language identification by prediction by partial matching.

Each language has a byte context tree with frozen counts. A byte costs its code length in the longest
context that has seen it; every context that has not adds the length of an escape (the number of different
followers over that number plus all followers), and what a longer context holds is excluded below it. A
text goes to the language whose tree codes it in the fewest bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_ROWS = 4000  # labelled documents per language that the trees are fitted on, about
UNDETERMINED = "und"
_SYMBOLS = 64  # the 63 commonest bytes, whose triples have a dense table, and one class for the others, whose triples are looked up
_START = b"\n\n"
_LETTER = re.compile(r"[^\W\d_]")


@dataclass(frozen=True)
class Model:
    """Code lengths in bits by (two bytes before, byte) and language, over all 256 byte values.

    ``bits`` repeats those of the commonest bytes by class triple; no text is coded by the class of the others.
    """

    languages: list[str]
    classes: np.ndarray  # byte -> class
    bits: np.ndarray  # class triple -> bits per language
    context: np.ndarray  # two bytes -> row of a context that any language has seen, 0 for none
    place: np.ndarray  # row and byte -> place in ``seen``, 0 for a triple that no language has seen
    seen: np.ndarray  # bits of the triples that any language has seen, per language
    escapes: np.ndarray  # row -> bits per language that a byte new in this context costs besides those of ``after``
    after: np.ndarray  # (byte before, byte) -> bits per language


def _bytes(text: str) -> bytes:
    return _START + text.encode("utf-8").lower()


def _triples(texts: list[bytes]) -> np.ndarray:
    b = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.int32)
    return (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]


def _follow(counts: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Probabilities of the next symbol per context row, from counts and the rows of the shorter context."""
    seen = counts > 0
    total, kinds = counts.sum(1, keepdims=True), seen.sum(1, keepdims=True)
    rest = np.where(seen, 0.0, below)
    mass = rest.sum(1, keepdims=True)
    # With no symbol left below there is nothing to escape to.
    escape = np.where(mass > 0, kinds, 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        own = np.where(total > 0, counts / np.maximum(total + escape, 1), 0.0)
        left = np.where(total > 0, escape / np.maximum(total + escape, 1), 1.0)
        return own + left * np.where(mass > 0, rest / np.where(mass > 0, mass, 1), 0.0)


def _tree(triples: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one language: bits after one byte, the two-byte contexts seen, bits of every byte in these, and bits of their escapes."""
    contexts, row = np.unique(triples >> 8, return_inverse=True)
    two = np.bincount(row * 256 + (triples & 255), weights=counts, minlength=len(contexts) * 256).reshape(-1, 256)
    one = np.bincount(triples & 0xFFFF, weights=counts, minlength=1 << 16).reshape(256, 256)
    p0 = _follow(one.sum(0, keepdims=True), np.full((1, 256), 1.0 / 256))
    p1 = _follow(one, np.repeat(p0, 256, 0))
    below = p1[contexts & 255]
    kinds, mass = (two > 0).sum(1), np.where(two > 0, 0.0, below).sum(1)
    escapes = np.where(mass > 0, np.log2(np.where(mass > 0, mass, 1)) - np.log2(kinds / (two.sum(1) + kinds)), 0.0)
    return -np.log2(p1).reshape(-1), contexts, -np.log2(_follow(two, below)), escapes


def _exact(m: Model, triples: np.ndarray) -> np.ndarray:
    """Bits per language of byte triples of any kind."""
    row = m.context[triples >> 8]
    place = m.place[row * 256 + (triples & 255)]
    out = m.seen[place]
    new = np.flatnonzero(place == 0)
    out[new] = m.escapes[row[new]] + m.after[triples[new] & 0xFFFF]
    return out


def _model(table: pd.DataFrame) -> Model:
    """The trees of the languages in rows of ``lang``, ``triple`` and ``n``."""
    by_byte = np.bincount(table["triple"] & 255, weights=table["n"], minlength=256)
    classes = np.full(256, _SYMBOLS - 1, np.uint8)
    common = sorted(range(256), key=lambda b: (-by_byte[b], b))[: _SYMBOLS - 1]
    classes[common] = np.arange(len(common))
    languages = sorted(table["lang"].unique())
    triples = np.unique(table["triple"].to_numpy(np.int32))
    known = np.unique(triples >> 8)
    context = np.zeros(1 << 16, np.int32)
    context[known] = np.arange(1, len(known) + 1)
    place = np.zeros((len(known) + 1) * 256, np.int32)
    place[context[triples >> 8] * 256 + (triples & 255)] = np.arange(1, len(triples) + 1)
    n = len(languages)
    seen, escapes, after = (np.zeros((rows, n), np.float32) for rows in (len(triples) + 1, len(known) + 1, 1 << 16))
    for k, lang in enumerate(languages):
        own = table[table["lang"] == lang]
        after[:, k], contexts, bits, left = _tree(own["triple"].to_numpy(np.int32), own["n"].to_numpy())
        escapes[context[contexts], k] = left
        row = np.minimum(np.searchsorted(contexts, triples >> 8), len(contexts) - 1)
        seen[1:, k] = np.where(contexts[row] == triples >> 8, bits[row, triples & 255], after[triples & 0xFFFF, k])
    dense = np.full((_SYMBOLS,) * 3 + (n,), np.log2(_SYMBOLS), np.float32)
    m = Model(languages, classes, dense.reshape(_SYMBOLS**3, n), context, place, seen, escapes, after)
    others = np.flatnonzero(classes == _SYMBOLS - 1)
    pairs = np.array(common, np.int32)[:, None] << 8 | np.arange(256, dtype=np.int32)
    for first, b in enumerate(common):
        bits = _exact(m, (b << 16 | pairs).reshape(-1)).reshape(len(common), 256, n)
        dense[first, :-1, :-1] = bits[:, common]
        dense[first, :-1, -1] = -np.log2(np.exp2(-bits[:, others].astype(np.float64)).sum(1))
    return m


def fit(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "lang", train_rows: int = TRAIN_ROWS) -> Model:
    """Fit the trees on about ``train_rows`` rows per language, chosen by a hash of the id.

    Rows with a null text or label are no samples. The counts come from a job over those rows; what
    reaches the driver is one row per language and different byte triple.
    """
    rows = docs.where(F.col(label_column).isNotNull() & F.col(text_column).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(label_column).count().collect()}
    if not sizes:
        return _model(pd.DataFrame({"lang": pd.Series(dtype=str), "triple": pd.Series(dtype=np.int32), "n": pd.Series(dtype=np.int64)}))
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, train_rows / n))])
    drawn = F.pmod(F.xxhash64(F.col(id_column), F.lit(8)), F.lit(1_000_003)) < share[F.col(label_column)] * 1_000_003

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                # The bytes that end one text and begin the next meet only in triples over the two start bytes.
                found, n = np.unique(_triples([_bytes(t) for t in texts]), return_counts=True)
                yield pd.DataFrame({"lang": lang, "triple": found, "n": n.astype(np.int64)})

    parts = rows.where(drawn).select(F.col(label_column).alias("lang"), F.col(text_column).alias("text")).mapInPandas(count, "lang string, triple int, n bigint")
    return _model(parts.groupBy("lang", "triple").agg(F.sum("n").alias("n")).toPandas())


def code_lengths(model: Model, texts: list[str]) -> np.ndarray:
    """Bits of every text under every language."""
    out = np.zeros((len(texts), len(model.languages)))
    k = _SYMBOLS
    for at, text in enumerate(texts):
        b = np.frombuffer(_bytes(text), dtype=np.uint8)
        for start in range(0, len(b) - 2, 1 << 20):
            own = b[start : start + (1 << 20) + 2]
            c = model.classes[own].astype(np.int32)
            code = (c[:-2] * k + c[1:-1]) * k + c[2:]
            other = c == k - 1
            if other.any():
                other = other[:-2] | other[1:-1] | other[2:]
                out[at] += _exact(model, _triples([own.tobytes()])[other]).sum(0, dtype=np.float64)
                code = code[~other]
            out[at] += model.bits[code].sum(0, dtype=np.float64)
    return out


def _judge(m: Model, texts: list[str | None]) -> list[tuple[str, float, float | None]]:
    """Language, posterior and bits per byte of every text."""
    clean = [t or "" for t in texts]
    known = [bool(m.languages) and _LETTER.search(t) is not None for t in clean]
    out: list[tuple[str, float, float | None]] = []
    for text, row, k in zip(clean, code_lengths(m, [t if k else "" for t, k in zip(clean, known, strict=True)]), known, strict=True):
        if not k:
            out.append((UNDETERMINED, 0.0, None))
            continue
        best = int(row.argmin())
        posterior = float(1.0 / np.exp2(np.maximum(row[best] - row, -1000.0)).sum())
        out.append((m.languages[best], posterior, float(row[best] / len(text.encode("utf-8")))))
    return out


def predict(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: the id column, ``lang_pred``, ``score`` and ``bits_per_byte``.

    ``score`` is the posterior of the language under equal priors. A null text, a text without a letter and
    a model without languages give ``und`` with score 0 and no bits. Equal lengths go to the first language
    by name. Other columns are not looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = _judge(sent.value, [None if t is None else t for t in batch["text"]])
            names, scores, rates = zip(*found, strict=True) if found else ((), (), ())
            yield pd.DataFrame({"key": batch["key"], "lang_pred": names, "score": scores, "bits_per_byte": pd.array(rates, dtype="Float64")})

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(docs[id_column].alias("key"), docs[text_column].alias("text"))
    return rows.mapInPandas(run, f"key {kind}, lang_pred string, score double, bits_per_byte double").withColumnRenamed("key", id_column)


def known_rows(docs: DataFrame, model: Model, at_least: float = 0.5, text_column: str = "text") -> DataFrame:
    """The whole rows of ``docs`` whose text has a language with a posterior of ``at_least``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = _judge(sent.value, batch.column(place).to_pylist())
            yield batch.filter(pa.array([lang != UNDETERMINED and score >= at_least for lang, score, _ in found], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)

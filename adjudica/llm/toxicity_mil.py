"""Toxicity by multiple-instance learning: a document is toxic if one of its sentences is.

A sentence has a logistic score over words; the document's probability is the noisy-or of its sentences,
one minus the product of one minus each. Only document labels are needed: the gradient of the document's
likelihood finds the sentences that explain it. Afterwards the sentence scores locate the offence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adjudica.llm.shared import sample_filter
from adjudica.session import stage

TRAIN_ROWS = 20_000  # labelled documents the classifier is fitted on, about
VOCABULARY = 2_000  # words with a weight
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Model:
    """Weight per word, and the score of a sentence without any of them."""

    weights: dict[str, float]
    bias: float


def _sentences(text: str) -> list[tuple[int, int, set[str]]]:
    return [(m.start(), m.end(), set(_WORD.findall(m.group().lower()))) for m in _SENTENCE.finditer(text)]


def fit_noisy_or(docs: np.ndarray, sentences: np.ndarray, words: np.ndarray, bare: np.ndarray, labels: np.ndarray, vocabulary: int, steps: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias from triples (document of sentence, sentence of word, word) and bare-sentence counts.

    ``bare`` counts, per document, its sentences without a vocabulary word.
    """
    w, bias = np.zeros(vocabulary), -4.0
    m, v = np.zeros(vocabulary + 1), np.zeros(vocabulary + 1)
    n, count = len(labels), len(docs)
    for t in range(1, steps + 1):
        z = bias + np.bincount(sentences, weights=w[words], minlength=count)
        rate = np.logaddexp(0, z)
        total = np.bincount(docs, weights=rate, minlength=n) + bare * np.logaddexp(0, bias)
        gone = np.exp(-np.maximum(total, 1e-9))
        slope = np.where(labels == 1, -gone / (1 - gone), 1.0)
        dz = slope[docs] / (1 + np.exp(-z))
        grad = np.bincount(words, weights=dz[sentences], minlength=vocabulary) + 0.02 * w
        grad_b = dz.sum() + (slope * bare).sum() / (1 + np.exp(-bias))
        g = np.append(grad, grad_b) / n
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        w, bias = w - step[:-1], bias - step[-1]
    return w, float(bias)


def fit(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on about ``train_rows`` labelled documents, chosen by a hash of the id.

    Null labels, ids and texts are no samples; several labels of one id count as their largest. Without
    samples of both kinds every score is 0. The sample is staged; words and their document counts are
    found by a job over it, and the driver gets word numbers of the sampled documents only.
    """
    spark = docs.sparkSession
    marks = labels.where(F.col(label_column).isNotNull() & F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("key")).agg(F.max(label_column).alias("label"))
    marks = marks.where(sample_filter(F.col("key"), marks.count(), train_rows, 6))
    texts = docs.where(docs[text_column].isNotNull()).select(docs[id_column].alias("key"), docs[text_column].alias("text"))
    # At most about train_rows pairs of an id and a label are broadcast.
    sample = stage(texts.join(F.broadcast(marks), "key").dropDuplicates(["key"]).select("text", "label"), "toxicity-sample")
    sizes = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    if not n1 or not n0:
        return Model({}, float("-inf"))
    words = sample.select("label", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"([\p{L}\p{N}_]+)")))).alias("word"))
    counts = words.groupBy("word").agg(F.sum("label").alias("d1"), F.sum(1 - F.col("label")).alias("d0")).where(F.col("d1") + F.col("d0") >= 5)
    p1, p0, p = F.col("d1") / n1, F.col("d0") / n0, (F.col("d1") + F.col("d0")) / (n1 + n0)
    z = F.abs(p1 - p0) / F.sqrt(F.greatest(p * (1 - p), F.lit(1e-9)) * (1 / n1 + 1 / n0))
    chosen = [r[0] for r in counts.where(z > 4).orderBy(z.desc(), "word").limit(VOCABULARY).select("word").collect()]
    number = spark.sparkContext.broadcast({w: i for i, w in enumerate(chosen)})

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bare, blobs = [], []
            for text in batch["text"]:
                empty, flat = 0, []
                for _, _, found in _sentences(text):
                    ids = [number.value[w] for w in found if w in number.value]
                    if ids:
                        flat += [*ids, -1]
                    else:
                        empty += 1
                bare.append(empty)
                blobs.append(np.array(flat, "<i4").tobytes())
            yield pd.DataFrame({"label": batch["label"].astype(int), "bare": bare, "ids": blobs})

    rows = sample.mapInPandas(encode, "label int, bare int, ids binary").toPandas()
    doc_of, sentence_of, word_of, sentence = [], [], [], 0
    for k, blob in enumerate(rows["ids"]):
        flat = np.frombuffer(blob, "<i4")
        ends = flat == -1
        local = np.cumsum(ends) - ends
        sentence_of.append(local[~ends] + sentence)
        word_of.append(flat[~ends])
        doc_of.append(np.full(int(ends.sum()), k))
        sentence += int(ends.sum())
    w, bias = fit_noisy_or(np.concatenate(doc_of), np.concatenate(sentence_of), np.concatenate(word_of), rows["bare"].to_numpy(float), rows["label"].to_numpy(), len(chosen))
    return Model(dict(zip(chosen, w.tolist(), strict=True)), bias)


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", at_least: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: the id column, ``score``, and ``offending`` sentences.

    ``offending`` holds start, end (code points) and probability of every sentence that alone reaches
    ``at_least``. A null or empty text has no sentence and score 0. Other columns are not looked at.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights, bias = sent.value.weights, sent.value.bias
        bare = float(np.logaddexp(0, bias))
        limit = float(np.log(at_least / (1 - at_least)))
        for batch in batches:
            scores, places = [], []
            for text in batch["text"]:
                total, found = 0.0, []
                for start, end, words in _sentences(text or ""):
                    known = weights.keys() & words
                    if not known:
                        total += bare
                        continue
                    z = bias + sum(sorted(weights[w] for w in known))
                    total += float(np.logaddexp(0, z))
                    if z >= limit:
                        found.append({"start": start, "end": end, "p": float(1 / (1 + np.exp(-z)))})
                scores.append(float(-np.expm1(-total)))
                places.append(found)
            yield pd.DataFrame({"key": batch["key"], "score": scores, "offending": places})

    kind = docs.schema[id_column].dataType.simpleString()
    rows = docs.select(docs[id_column].alias("key"), docs[text_column].alias("text"))
    return rows.mapInPandas(run, f"key {kind}, score double, offending array<struct<start:int,end:int,p:double>>").withColumnRenamed("key", id_column)

"""The training-data pipeline: five stages over the table of documents, each written and read again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.llm import language_ppm, secrets_markov, sentencepiece_table, superminhash, winnowing
from adjudica.llm.queries import tokenizer_path
from adjudica.llm.shared import table, workers_find_package
from adjudica.session import stage, tune


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that have a language; those without a letter or without a clear language go.

    Null and empty texts have no letter. Rows are judged one by one by their text, whatever their id, so repeated rows
    share a fate and a null id changes nothing. Without labelled languages no text has a clear one. An empty
    table gives an empty table; other columns are kept.
    """
    return language_ppm.known_rows(docs, language_ppm.fit(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id; rows without id stay.

    Each row is judged by its own text, so unrelated texts under one id all stay. Of copies equal in id and text
    one stays, and of one id's texts with equal shingles the one whose hash is smallest.
    """
    found = superminhash.decisions(docs).where("kept and doc_id is not null")
    kept = found.groupBy("doc_id", F.coalesce("tie", "body").alias("tie")).agg(F.min("body").alias("_kept_body")).withColumnRenamed("doc_id", "_kept_id")
    named = docs.where("doc_id is not null").withColumn("_body", F.xxhash64("text"))
    same = (F.col("doc_id") == F.col("_kept_id")) & (F.col("_body") == F.col("_kept_body"))
    own = named.join(kept.select("_kept_id", "_kept_body"), same, "left_semi").dropDuplicates(["doc_id", "_body"])
    return own.select(docs.columns).unionByName(docs.where("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window with a benchmark item; rows that share an id, or have none, go by their own text."""
    found = winnowing.contamination(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    dirty = found.where(F.size("hits") > 0).select(F.col("doc_id").alias("_dirty_id"), F.col("body").alias("_dirty_body")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_dirty_id")) & (winnowing.body_of(F.col("text")) == F.col("_dirty_body"))
    return docs.join(dirty, same, "left_anti").select(docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every secret and ``n_chars`` counted anew.

    Null texts stay null and empty ones empty. Every row stays, repeated ones and those without id too; other columns are
    kept as they are. An empty table gives an empty table.
    """
    clean = secrets_markov.redact(docs, secrets_markov.fit(docs))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document, and a hash of the text that decoding them gives back.

    A null or empty text has no ids. Every row has a result, repeated ones and those without id too; an empty table
    gives none. Texts of any length are encoded whole.
    """
    coded = sentencepiece_table.encode_decode(docs, tokenizer_path("piece_bpe_32k.model"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _ready(function: Stage) -> Stage:
    return lambda spark, docs, sf_dir: function(workers_find_package(tune(spark)), docs, sf_dir)


STAGES: list[tuple[str, Stage]] = [
    ("language", _ready(language)),
    ("near_dedup", _ready(near_dedup)),
    ("decontaminate", _ready(decontaminate)),
    ("redact_secrets", _ready(redact_secrets)),
    ("encode", _ready(encode)),
]

# SQL has no form of the byte context trees and the tokenizer; tests/llm/test_pipeline.py compares with plain Python.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the table of documents, one after the other."""
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

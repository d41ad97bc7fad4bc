"""A stored index for documents that contain a term: appended batch by batch, read only where a term may be.

Terms hold no separators, so a document contains a term exactly if one of its words does. The index holds each
word's first documents, and which words hold which three letters. A term looks up its rarest three letters,
compares the few words that have them, and reads their documents. Both tables are stored state with key
filters, so a lookup opens only runs and buckets that may hold its letters and words.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.functions import text as X
from adjudica.operators.lookup import topk_per_key
from adjudica.operators.outbox import publish_batch, state_for
from adjudica.session import stage

GRAM = 3
KEYS = {"words": ["word"], "letters": ["letters"]}


def _grams(word: Column) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(word) - (GRAM - 1)), lambda i: F.substring(word, i, F.lit(GRAM))))


def index_documents(docs: DataFrame, root: str, batch: str, doc_id: str = "doc_id", texts: Sequence[str] = ("text",), limit: int = 40) -> None:
    """Add a batch of documents to the index under ``root``; what ``texts`` name is searched as one text.

    Of each word the first ``limit`` documents of a batch are kept, by id, which is all a search with that limit can
    use. Words of fewer than three letters are not searched. A batch that is indexed again changes nothing.
    """
    text = F.lower(F.concat_ws(" ", *texts))
    long_enough = F.filter(F.split(text, X.WORD_BREAK), lambda w: F.length(w) >= GRAM)
    each = docs.select(doc_id, F.explode(X.distinct_sorted(long_enough)).alias("word"))
    heads = stage(topk_per_key(each, ["word"], [F.col(doc_id)], limit), "index-words")
    letters = heads.filter("rank = 1").select(F.explode(_grams(F.col("word"))).alias("letters"), "word")
    publish_batch({"words": heads.select("word", F.col(doc_id).alias("doc")), "letters": letters}, root, batch, KEYS)


def term_documents(terms: DataFrame, root: str, id_type: str, limit: int = 40) -> DataFrame:
    """(term, doc, rank): the first documents, by id, that contain the term in any case; terms in lower case, three letters or more."""
    asked = stage(terms.select("term").distinct().select("term", F.explode(_grams(F.col("term"))).alias("letters")), "asked-letters")
    stored = state_for(asked, root, "letters", "letters string, word string", ["letters"])
    met = stage(stored.join(asked.select("letters").distinct(), "letters", "left_semi").distinct(), "met-letters")
    sizes = met.groupBy("letters").agg(F.count(F.lit(1)).alias("n"))
    # A term of which some letters are in no word is in none; the others go by their rarest ones.
    rarest = asked.join(sizes, "letters", "left").groupBy("term").agg(F.bool_and(F.col("n").isNotNull()).alias("found"), F.min_by("letters", F.coalesce("n", F.lit(0))).alias("letters"))
    held = rarest.filter("found").join(met, "letters").filter(F.contains(F.col("word"), F.col("term"))).select("term", "word")
    held = stage(held, "held-words")
    postings = state_for(held, root, "words", f"word string, doc {id_type}", ["word"])
    # Every batch has a word's first documents; a term's first ones are among the first of each of its words.
    postings = topk_per_key(postings.distinct(), ["word"], [F.col("doc")], limit).select("word", "doc")
    return topk_per_key(postings.join(held, "word").select("term", "doc").distinct(), ["term"], [F.col("doc")], limit)

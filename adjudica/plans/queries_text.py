"""Queries over free text: personal data, words, documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica.functions import privacy as P
from adjudica.functions import text as X
from adjudica.functions.identity import content_id
from adjudica.plans import domain as D
from adjudica.plans import oracle as O
from adjudica.plans.registry import query

# Digit runs as a further kind, next to e-mail and dotted-quad addresses.
DIGITS = P.Pattern("NUMBER", "[0-9]{9,}", "digits")
CORPUS_PATTERNS = (P.EMAIL, P.IPV4, DIGITS)


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    """Every document with a contact line whose kind depends on the document's id."""
    ten = "lpad(cast(doc_id % 100000000 as string), 8, '0')"
    line = f"""case when doc_id % 5 = 4 then ' No contact.'
        when doc_id % 3 = 0 then concat(' Call +91 98', substr({ten}, 1, 3), ' ', substr({ten}, 4), ' today.')
        when doc_id % 3 = 1 then concat(' Holds 4444 ', substr({ten}, 1, 4), ' ', substr({ten}, 5), ' and 98', {ten})
        else concat(' Licence hr-20 201', {ten}, '.') end"""
    return D.documents(spark, sf).select("doc_id", "lang", "source", F.expr(f"concat(text, {line})").alias("text"))


_TEN = "lpad(cast(doc_id % 100000000 as varchar), 8, '0')"
_MASKED = f"""text || case when doc_id % 5 = 4 then ' No contact.'
    when doc_id % 3 = 0 then ' Call ' || {O.token('PHONE', f"'98' || {_TEN}")} || ' today.'
    when doc_id % 3 = 1 then ' Holds ' || {O.token('AADHAAR', f"'4444' || {_TEN}")} || ' and ' || {O.token('PHONE', f"'98' || {_TEN}")}
    else ' Licence ' || {O.token('DL', f"'HR20201' || {_TEN}")} || '.' end"""


@query("mask_text", f"select doc_id, sha256({_MASKED}) as masked_hash, length({_MASKED}) as masked_length from documents")
def mask_text(spark: SparkSession, sf: str) -> DataFrame:
    masked = corpus(spark, sf).select("doc_id", P.mask_text("text", D.SALT).alias("m"))
    return masked.select("doc_id", F.sha2("m", 256).alias("masked_hash"), F.length("m").cast("long").alias("masked_length"))


def sql_mask(text: str, kind: str, regex: str, canonical: str) -> str:
    """One masking pass: the gaps between matches and the tokens of the matches, put together again."""
    return f"""array_to_string(list_transform(list_zip(
        regexp_split_to_array({text}, '{regex}'),
        list_transform(regexp_extract_all({text}, '{regex}'), lambda m: '[{kind}:' || substr(sha256('{D.SALT}|{kind}|' || {canonical}), 1, 16) || ']')
      ), lambda z: coalesce(z[1], '') || coalesce(z[2], '')), '')"""


EMAIL_RE = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
IP_RE = r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}"


@query("mask_text_kinds", f"""
    with a as (select doc_id, {sql_mask('text', 'EMAIL', EMAIL_RE, 'lower(m)')} as text from documents),
    b as (select doc_id, {sql_mask('text', 'IP', IP_RE, "regexp_replace(upper(m), '[^A-Z0-9]', '', 'g')")} as text from a),
    c as (select doc_id, {sql_mask('text', 'NUMBER', '[0-9]{9,}', 'm')} as text from b)
    select doc_id, sha256(text) as masked_hash from c
""")
def mask_text_kinds(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.documents(spark, sf).select("doc_id", P.mask_text("text", D.SALT, patterns=CORPUS_PATTERNS).alias("m"))
    return docs.select("doc_id", F.sha2("m", 256).alias("masked_hash"))


@query("mask_column", O.with_(O.PEOPLE) + "select source_row, phone_masked, dl_masked, aadhaar_masked from people")
def mask_column(spark: SparkSession, sf: str) -> DataFrame:
    return D.people_rows(D.raw_people(spark, sf)).select("source_row", "phone_masked", "dl_masked", "aadhaar_masked")


@query("mask_canonical", """
    select c_custkey as k, '98' || lpad(cast(c_custkey % 100000000 as varchar), 8, '0') as phone,
      '4444' || lpad(cast(c_custkey % 100000000 as varchar), 8, '0') as national_id,
      'HR' || lpad(cast(c_custkey % 100 as varchar), 2, '0') || '201' || lpad(cast(c_custkey % 100000000 as varchar), 8, '0') as licence
    from customer
""")
def mask_canonical(spark: SparkSession, sf: str) -> DataFrame:
    return D.raw_people(spark, sf).select(
        (F.col("source_row") - 2).alias("k"), P.mask_canonical(F.col("phone"), "last10").alias("phone"),
        P.mask_canonical(F.col("aadhaar"), "digits").alias("national_id"),
        P.mask_canonical(F.col("dl_number"), "alnum").alias("licence"),
    )


@query("find_pii", """
    select doc_id, kind, cast(length(text) + spot as integer) as index, cast(n as integer) as length from documents
    join (values (0, 'PHONE', 6, 15), (1, 'AADHAAR', 7, 14), (1, 'PHONE', 26, 10), (2, 'DL', 9, 17)) v(r, kind, spot, n)
      on doc_id % 3 = r where doc_id % 5 <> 4
""")
def find_pii(spark: SparkSession, sf: str) -> DataFrame:
    hits = corpus(spark, sf).select("doc_id", F.explode(P.find_pii("text")).alias("h"))
    return hits.select("doc_id", "h.kind", "h.index", "h.length")


@query("find_pii_kinds", f"""
    select doc_id, (len(regexp_extract_all(text, '{EMAIL_RE}'))) as n_email, len(regexp_extract_all(text, '{IP_RE}')) as n_ip,
      len(regexp_extract_all(text, '[0-9]{{9,}}')) as n_number from documents
""")
def find_pii_kinds(spark: SparkSession, sf: str) -> DataFrame:
    hits = D.documents(spark, sf).select("doc_id", P.find_pii("text", CORPUS_PATTERNS).alias("h"))

    def count(kind: str) -> F.Column:
        return F.size(F.filter("h", lambda x: x["kind"] == kind)).cast("long")

    return hits.select("doc_id", count("EMAIL").alias("n_email"), count("IP").alias("n_ip"), count("NUMBER").alias("n_number"))


@query("assert_clean", "select lang, count(*) as n_docs from documents group by lang")
def assert_clean(spark: SparkSession, sf: str) -> DataFrame:
    masked = corpus(spark, sf).select("lang", P.mask_text("text", D.SALT).alias("text"))
    gated = P.gate_clean(masked, ["text"], "corpus")
    # The gate's value is used, so the optimizer cannot drop it.
    return gated.groupBy("lang").agg(F.count("text").alias("n_docs"))


@query("scan_leaks", "select lang, count(*) as n_scanned, count_if(doc_id % 5 <> 4) as n_leaking from documents group by lang")
def scan_leaks(spark: SparkSession, sf: str) -> DataFrame:
    return P.scan_leaks(corpus(spark, sf), ["text"], ["lang"])


_WORDS = """list_filter(regexp_split_to_array(trim(text, ' '), '[\\s,?.;:()"'']+'), lambda w: w <> '')"""
_STOP = "[" + ", ".join(f"'{w}'" for w in X.V.STOP_WORDS) + "]"


@query("tokenize", f"""
    select doc_id, len({_WORDS}) as n_words, len(kw) as n_keywords, sha256(array_to_string(kw, ' ')) as keywords_hash from (
      select *, list_filter(list_transform({_WORDS}, lambda w: lower(w)), lambda w: length(w) > 2 and not list_contains({_STOP}, w)) as kw from documents)
""")
def tokenize(spark: SparkSession, sf: str) -> DataFrame:
    docs = D.documents(spark, sf).select("doc_id", X.words("text").alias("w"), X.tokenize("text").alias("k"))
    return docs.select(
        "doc_id", F.size("w").cast("long").alias("n_words"), F.size("k").cast("long").alias("n_keywords"),
        F.sha2(F.array_join("k", " "), 256).alias("keywords_hash"),
    )


@query("content_id", "select doc_id, 'DOC-' || substr(sha256(text), 1, 32) as content_id from documents")
def doc_content_id(spark: SparkSession, sf: str) -> DataFrame:
    return D.documents(spark, sf).select("doc_id", content_id("DOC", "text").alias("content_id"))


@query("parse_json_col", """
    select event_id, coalesce(try_cast(json_extract_string(p, '$.k') as bigint), -1) as k from (
      select event_id, case when event_type = 'error' then null else props end as p from events)
""")
def parse_json_col(spark: SparkSession, sf: str) -> DataFrame:
    from adjudica.sources.context import parse_json_col as parse

    events = D.table(spark, sf, "events").select(
        "event_id", F.expr("case when event_type = 'error' then concat('{', props) else props end").alias("p")
    )
    parsed = events.select("event_id", parse("p", "k long", F.struct(F.lit(-1).cast("long").alias("k"))).alias("v"))
    return parsed.select("event_id", F.coalesce("v.k", F.lit(-1)).alias("k"))

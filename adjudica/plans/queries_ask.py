"""Queries that answer a table of questions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adjudica import rulebook as R
from adjudica import vocabulary as V
from adjudica.functions import privacy as P
from adjudica.functions import text as X
from adjudica.operators import retrieve, search_index
from adjudica.plans import domain as D
from adjudica.plans import oracle as O
from adjudica.plans.queries_entities import fleet_conflicts
from adjudica.plans.queries_text import CORPUS_PATTERNS, EMAIL_RE, IP_RE, sql_mask
from adjudica.plans.registry import query
from adjudica.session import scratch_path, spread, stage

_HUB_WORDS = ["ambala", "chandigarh", "delhi", "gurugram", "jaipur", "kanpur", "lucknow", "ludhiana", "rudrapur"]
_PARTY_WORDS = {"AUTOMOBILE": "Shakti", "BUILDING": "Orion", "FURNITURE": "vertex", "MACHINERY": "APEX", "HOUSEHOLD": "internal"}


def questions(spark: SparkSession, sf: str) -> DataFrame:
    """Questions of every kind about every vehicle, customer, nation and document."""
    t = lambda name: D.table(spark, sf, name)
    reg = D._reg("s_suppkey")
    party = " ".join(f"when '{k}' then '{v}'" for k, v in _PARTY_WORDS.items())
    parts = [
        t("supplier").selectExpr("s_suppkey * 10 + 1 as question_id", f"concat('What year is ', {reg} , ', and has it a heater?') as text"),
        t("supplier").selectExpr("s_suppkey * 10 + 2 as question_id", f"concat('Show the maintenance history of ', lower({reg})) as text"),
        t("supplier").selectExpr("s_suppkey * 10 + 3 as question_id", f"concat('Where is ', {reg}, ' right now?') as text"),
        t("customer").selectExpr("c_custkey * 10 + 4 as question_id", "concat('What tenure has driver drv', c_custkey, '?') as text"),
        t("nation").selectExpr("n_nationkey * 10L + 5 as question_id", f"concat('Which old fleet vehicles are at ', {D._pick(_HUB_WORDS, 'n_nationkey')}, '?') as text"),
        t("documents").selectExpr("doc_id * 10 + 6 as question_id", "concat('Tell me about ', array_join(slice(split(trim(text), ' +'), 3, 3), ' ')) as text"),
        t("customer").selectExpr("c_custkey * 10 + 7 as question_id", f"concat('What is the sla hours for ', case c_mktsegment {party} end, ' under R-SHAKTI-36H?') as text"),
        t("region").selectExpr("r_regionkey * 10L + 8 as question_id", "concat('zzqx ', r_regionkey) as text"),
    ]
    # Written once: otherwise every later expression is planned once per part of the union. Dealt evenly: a table of
    # customers is few splits and many questions.
    cores = spark.sparkContext.defaultParallelism
    return spread(stage(reduce(DataFrame.unionByName, parts).repartition(cores), "questions"))


_QUESTIONS = f"""
questions as (
  select s_suppkey * 10 + 1 as question_id, 'What year is ' || {O.reg("s_suppkey")} || ', and has it a heater?' as text from supplier
  union all select s_suppkey * 10 + 2, 'Show the maintenance history of ' || lower({O.reg("s_suppkey")}) from supplier
  union all select s_suppkey * 10 + 3, 'Where is ' || {O.reg("s_suppkey")} || ' right now?' from supplier
  union all select c_custkey * 10 + 4, 'What tenure has driver drv' || c_custkey || '?' from customer
  union all select cast(n_nationkey as bigint) * 10 + 5, 'Which old fleet vehicles are at ' || {O.pick(_HUB_WORDS, "n_nationkey")} || '?' from nation
  union all select doc_id * 10 + 6, 'Tell me about ' || array_to_string(list_slice(regexp_split_to_array(trim(text, ' '), ' +'), 3, 5), ' ') from documents
  union all select c_custkey * 10 + 7, 'What is the sla hours for ' || case c_mktsegment {" ".join(f"when '{k}' then '{v}'" for k, v in _PARTY_WORDS.items())} end || ' under R-SHAKTI-36H?' from customer
  union all select cast(r_regionkey as bigint) * 10 + 8, 'zzqx ' || r_regionkey from region
)"""
_SPLIT = """list_filter(regexp_split_to_array(trim(text, ' '), '[\\s,?.;:()"'']+'), lambda w: w <> '')"""
_STOP = "[" + ", ".join(f"'{w}'" for w in V.STOP_WORDS) + "]"
_LIST = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
_INTENTS = "[" + ", ".join(
    f"case when regexp_matches(text, '(?i){regex}') then '{name}' end" for name, regex in V.INTENTS
) + "]"
_PARTY_CASE = "case lower(w) " + " ".join(
    f"when '{w}' then '{V.PARTY_ALIASES[w]}'" for w in V.PARTY_WORDS
) + " end"
_PLACE_CASE = "case lower(w) " + " ".join(f"when '{w}' then '{V.PLACE_ALIASES[w]}'" for w in V.PLACE_WORDS) + " end"
_PARSED = f"""
worded as (select question_id, text, {_SPLIT} as words from questions),
parsed as (
  select *, list_filter(list_transform(words, lambda w: lower(w)), lambda w: length(w) > 2 and not list_contains({_STOP}, w)) as keywords,
    list_filter({_INTENTS}, lambda x: x is not null) as intents,
    list_filter(list_transform(list_filter(words, lambda w: regexp_matches(w, '^[A-Za-z]{{2}}[-\\s]?[0-9]{{1,2}}')), lambda w: regexp_replace(upper(w), '[^A-Z0-9]', '', 'g')),
      lambda k: length(k) between 8 and 12 and regexp_matches(k, '^[A-Z]{{2}}[0-9]')) as vehicles,
    list_filter(list_transform(words, lambda w: case when regexp_matches(w, '(?i)drv[^0-9]*[0-9]') then
      'DRV-' || lpad(regexp_extract(upper(w), 'DRV[^0-9]*([0-9]+)', 1), cast(greatest(3, length(regexp_extract(upper(w), 'DRV[^0-9]*([0-9]+)', 1))) as integer), '0') end), lambda x: x is not null) as people,
    list_filter(list_transform(words, lambda w: {_PARTY_CASE}), lambda x: x is not null) as parties,
    list_filter(list_transform(words, lambda w: {_PLACE_CASE}), lambda x: x is not null) as places,
    list_transform(regexp_extract_all(text, '(?i)R-[A-Z0-9-]+'), lambda x: upper(x)) as rules
  from worded
)"""
PARSED = O.with_(_QUESTIONS, _PARSED)


@query("tag_intents", PARSED + "select question_id, array_to_string(intents, ',') as intents from parsed")
def tag_intents(spark: SparkSession, sf: str) -> DataFrame:
    return questions(spark, sf).select("question_id", F.array_join(X.tag_intents("text"), ",").alias("intents"))


@query("tag_intents_conversations", f"""
    with questions as (select conv_id * 1000 + turn as question_id, text from conversations)
    select question_id, array_to_string(list_filter({_INTENTS}, lambda x: x is not null), ',') as intents from questions
""")
def tag_intents_conversations(spark: SparkSession, sf: str) -> DataFrame:
    c = D.table(spark, sf, "conversations")
    return c.select((F.col("conv_id") * 1000 + F.col("turn")).alias("question_id"), F.array_join(X.tag_intents("text"), ",").alias("intents"))


_MENTION_KINDS = ("vehicles", "people", "parties", "places", "rules")


@query("link_mentions", PARSED + " union all ".join(
    f"select question_id, '{k}' as kind, array_to_string(list_distinct({k}), ',') as mentions from parsed where len({k}) > 0" for k in _MENTION_KINDS
))
def link_mentions(spark: SparkSession, sf: str) -> DataFrame:
    parsed = retrieve.parse_questions(questions(spark, sf))
    kinds = F.array(
        *[F.struct(F.lit(k).alias("kind"), F.array_join(F.array_distinct(F.col(k)), ",").alias("mentions")) for k in _MENTION_KINDS]
    )
    return parsed.select("question_id", F.explode(kinds).alias("m")).select("question_id", "m.*").filter("mentions <> ''")


_ENTITIES = """
named as (select distinct question_id, v as reg_canon from (select question_id, unnest(vehicles) as v from parsed) join fleet on v = reg_canon),
entities as (
  select * from named
  union all
  select p.question_id, f.reg_canon from (select question_id, unnest(places) as place from parsed where list_contains(intents, 'vehicle_spec')) p
  join (select * from fleet qualify row_number() over (partition by home_hub order by reg_canon) <= 12) f on f.home_hub = p.place
  where p.question_id not in (select question_id from named)
)"""


@query("fetch_entities", O.with_(O.FLEET, _QUESTIONS, _PARSED, _ENTITIES) + "select * from entities")
def fetch_entities(spark: SparkSession, sf: str) -> DataFrame:
    parsed = retrieve.parse_questions(questions(spark, sf))
    return retrieve.fetch_entities(parsed, D.fleet(spark, sf)).select("question_id", "reg_canon")


_BOOK = R.ordered(R.DEFAULT_RULES)
_RULE_VALUES = ", ".join(
    "(" + ", ".join([str(i), f"'{r.id}'", "'" + f"{r.id} {r.name} {r.quote} {r.reason}".lower().replace("'", "''") + "'"]) + ")"
    for i, r in enumerate(_BOOK)
)
_HINT_VALUES = ", ".join(f"('{p}', {i}, '{rid}')" for p, ids in V.PARTY_RULE_HINTS.items() for i, rid in enumerate(ids))
_RULE_HITS = f"""
book as (select * from (values {_RULE_VALUES}) v(i, rule_id, hay)),
hints as (select * from (values {_HINT_VALUES}) v(party, i, rule_id)),
rule_found as (
  select question_id, 0 as way, i, rule_id from (select question_id, unnest(rules) as rule_id, generate_subscripts(rules, 1) as i from parsed) join (select rule_id from book) using (rule_id)
  union all select question_id, 1, i, rule_id from (select question_id, unnest(parties) as party from parsed) join hints using (party)
  union all select question_id, 2, i, rule_id from parsed, book
    where list_has_any(intents, ['rule', 'client_rule']) and len(list_filter(keywords, lambda k: contains(hay, k))) > 0
),
rule_hits as (
  select question_id, rule_id, row_number() over (partition by question_id order by at_way) - 1 as pos
  from (select question_id, rule_id, min((way, i)) as at_way from rule_found group by 1, 2)
  qualify row_number() over (partition by question_id order by at_way) <= 6
)"""


@query("search_rules", O.with_(_QUESTIONS, _PARSED, _RULE_HITS) + "select question_id, pos, rule_id from rule_hits")
def search_rules(spark: SparkSession, sf: str) -> DataFrame:
    hits = retrieve.search_rules(retrieve.parse_questions(questions(spark, sf)), R.DEFAULT_RULES)
    return hits.select("question_id", F.col("pos").cast("long").alias("pos"), "rule_id")


_DOC_HITS = """
terms as (
  select question_id, pos, term from (
    select question_id, unnest(ts) as term, generate_subscripts(ts, 1) as pos
    from (select question_id, list_slice(list_concat(list_transform(parties, lambda p: split_part(p, '_', 1)), keywords), 1, 6) as ts from parsed))
),
low as materialized (select doc_id, lower(text) as t from documents),
hits as (
  select term, doc_id, row_number() over (partition by term order by doc_id) as r
  from (select distinct term from terms), low where contains(t, term) qualify r <= 40
),
doc_hits as (
  select question_id, doc_id, row_number() over (partition by question_id order by spot) as pos from (
    select question_id, doc_id, min((pos, r)) as spot from terms join hits using (term) group by 1, 2)
  qualify row_number() over (partition by question_id order by spot) <= 4
)"""


@query("search_documents", O.with_(_QUESTIONS, _PARSED, _DOC_HITS) + "select question_id, pos, doc_id from doc_hits")
def search_documents(spark: SparkSession, sf: str) -> DataFrame:
    parsed = stage(retrieve.parse_questions(questions(spark, sf)), "parsed")
    docs, root = stage(D.documents(spark, sf).select("doc_id", "text"), "documents"), scratch_path(spark, "search-index")
    # Two batches of ids that alternate.
    for label, half in (("odd", F.col("doc_id") % 2 == 1), ("even", F.col("doc_id") % 2 == 0)):
        search_index.index_documents(docs.where(half), root, label)
    hits = retrieve.search_documents(parsed, docs, index=root)
    return hits.select("question_id", F.col("pos").cast("long").alias("pos"), "doc_id")


_SNIPPET = """
(select case when b is null then trim(substr(text, 1, 240), ' ')
   else case when b > 81 then '…' else '' end || trim(substr(text, greatest(1, b - 80), 240), ' ') || '…' end
 from (select list_min(list_filter(list_transform({ks}, lambda k: instr(lower(text), k)), lambda i: i > 0)) as b))"""


@query("snippet", f"""
    select doc_id, sha256({_SNIPPET.format(ks="['ing', 'ent', 'que']")}) as snippet_hash from documents
""")
def snippet(spark: SparkSession, sf: str) -> DataFrame:
    words = F.array(F.lit("ing"), F.lit("ent"), F.lit("que"))
    return D.documents(spark, sf).select("doc_id", F.sha2(X.snippet("text", words), 256).alias("snippet_hash"))


def store(spark: SparkSession, sf: str) -> retrieve.Store:
    """What answers are drawn from."""
    docs = D.documents(spark, sf).select(
        "doc_id", P.mask_text("text", D.SALT, patterns=(*P.DEFAULT_PATTERNS, *CORPUS_PATTERNS)).alias("text")
    )
    return retrieve.Store(
        fleet=stage(D.fleet(spark, sf), "fleet"), people=stage(D.people(spark, sf), "people"),
        history=stage(D.history(spark, sf), "history"), conflicts=stage(fleet_conflicts(spark, sf), "conflicts"),
        documents=stage(docs, "documents"),
    )


_N = O.NUM
_SAID = {r.id: f'{r.id} - {r.name}: {r.reason or r.effect}. "{r.quote}"' + (" [not enforced]" if r.implemented is False else "") for r in _BOOK}
_SAID_VALUES = ", ".join(f"('{k}', '{v}')" for k, v in _SAID.items())
_MASKED_DOCS = f"""
mask_a as (select doc_id, {sql_mask("text", "EMAIL", EMAIL_RE, "lower(m)")} as text from documents),
mask_b as (select doc_id, {sql_mask("text", "IP", IP_RE, "regexp_replace(upper(m), '[^A-Z0-9]', '', 'g')")} as text from mask_a),
masked as (select doc_id, {sql_mask("text", "NUMBER", "[0-9]{9,}", "m")} as text from mask_b)"""
_ANSWERS = f"""
log_lines as (
  select reg_canon, i, line from (
    select reg_canon, row_number() over (partition by reg_canon order by history.day desc, odometer desc nulls last, mechanic, notes) as i,
      '  ' || strftime(history.day, '%Y-%m-%d') || '  ' || coalesce(cast(odometer as varchar), 'null') || ' km  ' || mechanic || ': ' || notes as line from history) where i <= 8
),
here as (select * from parsed where not list_contains(intents, 'location')),
has_entity as (
  select question_id from entities union select question_id from rule_hits
  union select question_id from (select question_id, unnest(people) as driver_id from here) join people using (driver_id)
),
lines as (
  select question_id, 1 as section, reg_canon as k, 0 as i, reg_canon || ' (' || vehicle_id || '): ' || concat_ws(', ', cast(year as varchar), model, bs_stage,
      case when heater then 'engine heater' when not heater then 'no engine heater' end, {_N.format("capacity")} || 't', 'home hub ' || home_hub) || '.' as line
  from entities join fleet using (reg_canon)
  union all select question_id, 2, reg_canon || field, 0, 'Conflict on ' || reg_canon || ' ' || field || ': ' || winner || ' was taken over ' || loser || '.'
  from entities join conflicts using (reg_canon)
  union all select question_id, 3, '', 0, driver_id || ' ' || name || ', joined ' || strftime(joined, '%Y-%m-%d') || ', home hub ' || home_hub || '. Contact details are masked (' || phone_masked || ').'
  from (select question_id, unnest(people) as driver_id from parsed) join people using (driver_id)
  union all select question_id, 4, '', 0, n || ' maintenance entries on record, most recent first:'
  from entities join (select reg_canon, count(*) as n from history group by 1) using (reg_canon) join parsed using (question_id) where list_contains(intents, 'maintenance')
  union all select question_id, 5, '', l.i, line from entities join log_lines l using (reg_canon) join parsed using (question_id) where list_contains(intents, 'maintenance')
  union all select question_id, 6, '', cast(pos as integer), v.line from rule_hits join (values {_SAID_VALUES}) v(rule_id, line) using (rule_id)
  union all select question_id, 7, '', cast(pos as integer), d.doc_id || ': ' || {_SNIPPET.format(ks="h.keywords").replace("text", "d.text")}
  from doc_hits join masked d using (doc_id) join here h using (question_id)
  where len(h.parties) > 0 or question_id not in (select question_id from has_entity)
)"""
_DOC_HITS_MASKED = _DOC_HITS.replace("lower(text) as t from documents", "lower(text) as t from masked")


@query("answer_questions", O.with_(O.FLEET, O.CONFLICTS, O.HISTORY, O.PEOPLE, _QUESTIONS, _PARSED, _ENTITIES, _RULE_HITS, _MASKED_DOCS, _DOC_HITS_MASKED, _ANSWERS) + """
    select question_id, coalesce(l.question_id is not null, false) as sufficient,
      case when list_contains(intents, 'location') then 'Insufficient data. No live position is held, so where anything is now cannot be answered.'
        else coalesce(a, 'Insufficient data. Nothing stored answers that.') end as answer
    from parsed left join (select question_id, string_agg(line, chr(10) order by section, i, k) as a from lines
      where question_id in (select question_id from here) group by 1) l using (question_id)
""")
def answer_questions(spark: SparkSession, sf: str) -> DataFrame:
    parsed = stage(retrieve.parse_questions(questions(spark, sf)), "parsed")
    return retrieve.answer_questions(parsed, store(spark, sf), R.DEFAULT_RULES).select("question_id", "sufficient", "answer")

"""Questions answered from stored rows only, with citations, or refused."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica import vocabulary as V
from adjudica.functions import canonical as C
from adjudica.functions import text as X
from adjudica.operators import search_index
from adjudica.operators.lookup import topk_per_key
from adjudica.rulebook import Rule, ordered
from adjudica.session import scratch_path, stage

MAX_TERMS = 6
HITS_PER_TERM = 40
MAX_DOCUMENTS = 4
MIN_TERM = 3
MAX_RULES = 6
MAX_HUB_VEHICLES = 12
MAX_HISTORY_LINES = 8
PER_TEXT_COPY = 256  # word lists that meet one copy of a text in one task

REFUSED_LOCATION = "Insufficient data. No live position is held, so where anything is now cannot be answered."
REFUSED_NOTHING = "Insufficient data. Nothing stored answers that."


def link_mentions(words: Column) -> dict[str, Column]:
    """Entities a question names: vehicles, people, parties, places; rule ids need the whole text."""
    regs = F.filter(
        F.transform(F.filter(words, lambda w: w.rlike(r"^[A-Za-z]{2}[-\s]?\d{1,2}")), C.norm_key),
        lambda k: F.length(k).between(8, 12) & k.rlike(r"^[A-Z]{2}\d"),
    )
    people = F.array_compact(
        F.transform(F.filter(words, lambda w: w.rlike("(?i)drv")), lambda w: C.norm_prefixed_id(w))
    )
    parties = F.array_distinct(
        F.transform(F.filter(words, lambda w: F.lower(w).isin(*V.PARTY_WORDS)), lambda w: C.norm_alias(w))
    )
    places = F.array_distinct(
        F.transform(F.filter(words, lambda w: F.lower(w).isin(*V.PLACE_WORDS)), lambda w: C.norm_place(w))
    )
    return {"vehicles": regs, "people": people, "parties": parties, "places": places}


def mentioned_rules(text: Column | str) -> Column:
    """Rule ids in a text, in upper case and order."""
    value = F.col(text) if isinstance(text, str) else text
    return F.transform(F.regexp_extract_all(value, F.lit(r"(?i)R-[A-Z0-9-]+"), F.lit(0)), F.upper)


def parse_questions(questions: DataFrame, text: str = "text") -> DataFrame:
    """Questions with words, keywords, intents and mentions."""
    out = questions.withColumn("words", X.words(text))
    return out.withColumns(
        {**link_mentions(F.col("words")), "rules": mentioned_rules(text), "intents": X.tag_intents(text), "keywords": X.tokenize(text)}
    )


def fetch_entities(parsed: DataFrame, fleet: DataFrame) -> DataFrame:
    """(question_id, pos, reg_canon) of the vehicles an answer covers.

    Named vehicles that exist; where there are none, the first of each named place if the question is
    about vehicles.
    """
    named = parsed.select("question_id", F.posexplode("vehicles").alias("pos", "reg_canon")).join(
        fleet.select("reg_canon"), "reg_canon", "left_semi"
    )
    asks = (
        parsed.filter(F.array_contains("intents", "vehicle_spec") & (F.size("places") > 0))
        .join(named.select("question_id"), "question_id", "left_anti")
        .select("question_id", F.posexplode("places").alias("at", "home_hub"))
    )
    firsts = topk_per_key(
        fleet.select("home_hub", "reg_canon").filter("home_hub is not null"), ["home_hub"], [F.col("reg_canon")],
        MAX_HUB_VEHICLES,
    )
    by_hub = asks.join(firsts, "home_hub").select(
        "question_id", (F.col("at") * 100 + F.col("rank")).cast("int").alias("pos"), "reg_canon"
    )
    return named.select("question_id", "pos", "reg_canon").unionByName(by_hub)


def search_rules(parsed: DataFrame, rules: Sequence[Rule], hints: Mapping[str, Sequence[str]] = V.PARTY_RULE_HINTS) -> DataFrame:
    """(question_id, pos, rule_id): rules named, then hinted at by a party, then holding a keyword; the first six.

    The rulebook is a constant of the program, so each question is matched in its own row.
    """
    book = ordered(rules)
    asks_rules = F.arrays_overlap("intents", F.array(F.lit("rule"), F.lit("client_rule")))
    known = F.array(*[F.lit(r.id) for r in book])
    none = F.array().cast("array<string>")
    by_id = F.filter("rules", lambda r: F.array_contains(known, r))
    by_party = F.flatten(F.transform("parties", lambda p: _hint(p, hints, none)))
    hay = {r.id: f"{r.id} {r.name} {r.quote} {r.reason or ''}".lower() for r in book}
    by_word = F.array_compact(
        F.array(
            *[
                F.when(asks_rules & F.exists("keywords", _held_by(hay[r.id])), F.lit(r.id))
                for r in book
            ]
        )
    )
    found = F.slice(F.array_distinct(F.concat(by_id, by_party, by_word)), 1, MAX_RULES)
    return parsed.select("question_id", F.posexplode(found).alias("pos", "rule_id"))


def _held_by(text: str) -> Callable[[Column], Column]:
    return lambda k: F.contains(F.lit(text), k)


def _hint(party: Column, hints: Mapping[str, Sequence[str]], none: Column) -> Column:
    out = none
    for name, ids in hints.items():
        out = F.when(party == name, F.array(*[F.lit(i) for i in ids])).otherwise(out)
    return out


def search_terms(parsed: DataFrame, limit: int = MAX_TERMS) -> DataFrame:
    """(question_id, pos, term): a question's party names, then its keywords; the first six."""
    parties = F.transform("parties", lambda p: F.split_part(p, F.lit("_"), F.lit(1)))
    return parsed.select(
        "question_id", F.posexplode(F.slice(F.concat(parties, F.col("keywords")), 1, limit)).alias("pos", "term")
    ).filter(F.length("term") >= MIN_TERM)


def search_documents(
    parsed: DataFrame, docs: DataFrame, doc_id: str = "doc_id", texts: Sequence[str] = ("text",), limit: int = MAX_DOCUMENTS, index: str | None = None
) -> DataFrame:
    """(question_id, pos, doc_id): by term order, then by id, each document once, the first four.

    ``index`` is the folder of a stored index of ``docs`` (see ``search_index``); without one it is built for this call.
    """
    if index is None:
        index = scratch_path(docs.sparkSession, "search-index")
        search_index.index_documents(docs, index, "all", doc_id, texts, HITS_PER_TERM)
    terms = stage(search_terms(parsed), "terms")
    # Before a term's document of rank r, r - 1 others come for every question that asks the term, so a question's first
    # ``limit`` documents have ranks up to ``limit``.
    found = search_index.term_documents(terms, index, docs.schema[doc_id].dataType.simpleString(), min(limit, HITS_PER_TERM))
    firsts = found.groupBy("term").agg(F.collect_list(F.struct("rank", "doc")).alias("docs"))
    hits = terms.join(firsts, "term").select("question_id", F.transform("docs", lambda d: F.struct("pos", d["rank"].alias("rank"), d["doc"].alias("doc"))).alias("docs"))
    # A question has a few terms, each with a few documents.
    listed = hits.groupBy("question_id").agg(F.array_sort(F.flatten(F.collect_list("docs"))).alias("docs"))
    chosen = F.slice(F.array_distinct(F.transform("docs", lambda d: d["doc"])), 1, limit)
    return listed.select("question_id", F.posexplode(chosen).alias("at", doc_id)).select("question_id", (F.col("at") + 1).alias("pos"), doc_id)


def document_snippets(cited: DataFrame, docs: DataFrame, per_copy: int = PER_TEXT_COPY) -> DataFrame:
    """(doc_id, keywords, snippet): one row for each document and list of keywords in ``cited``, however many questions share them.

    A document that many lists ask for is copied, one copy for about ``per_copy`` lists, so that it is not one task.
    """
    pairs = stage(cited.select("doc_id", "keywords").distinct(), "snippets-asked")
    copies = pairs.groupBy("doc_id").agg(F.ceil(F.count(F.lit(1)) / per_copy).alias("copies"))
    texts = docs.select("doc_id", "text").join(copies, "doc_id").select("doc_id", "text", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
    dealt = pairs.join(copies, "doc_id").select("doc_id", "keywords", F.pmod(F.xxhash64("keywords"), F.col("copies")).alias("copy"))
    return dealt.join(texts, ["doc_id", "copy"]).select("doc_id", "keywords", X.snippet("text", "keywords").alias("snippet"))


@dataclass(frozen=True)
class Store:
    """What answers may be drawn from. Documents must already be masked; ``index`` is the folder of their index, if stored."""

    fleet: DataFrame
    people: DataFrame
    history: DataFrame
    conflicts: DataFrame
    documents: DataFrame
    index: str | None = None


def _line(section: int, pos: Column, line: Column, source: Column) -> list[Column]:
    return [
        F.col("question_id"), F.lit(section).alias("section"), pos.cast("long").alias("pos"),
        line.alias("line"), source.alias("source"),
    ]


def _text(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("null")) for p in parts])


def evidence(parsed: DataFrame, store: Store, rules: Sequence[Rule]) -> DataFrame:
    """All lines of all answers: question_id, section, pos, line, source."""
    c = F.col
    # Five sections read the covered vehicles, so they are found once.
    vehicles = stage(fetch_entities(parsed, store.fleet), "covered")
    details = F.concat_ws(
        ", ", c("year").cast("string"), c("model"), c("bs_stage"),
        F.when(c("engine_heater"), "engine heater").when(~c("engine_heater"), "no engine heater"),
        F.concat(F.regexp_replace(c("capacity_tonnes").cast("string"), r"\.0$", ""), F.lit("t")),
        F.concat(F.lit("home hub "), c("home_hub")),
    )
    name = F.concat(c("reg_canon"), F.coalesce(F.concat(F.lit(" ("), c("vehicle_id"), F.lit(")")), F.lit("")))
    vehicle_lines = vehicles.join(store.fleet, "reg_canon").select(
        *_line(1, c("pos"), F.concat(name, F.lit(": "), details, F.lit(".")), _text("fleet:", c("source_row")))
    )
    conflict_lines = vehicles.join(store.conflicts, "reg_canon").select(
        *_line(
            2, c("pos"),
            _text("Conflict on ", c("reg_canon"), " ", c("field"), ": ", c("winner"), " was taken over ", c("loser"), "."),
            _text("rules#", c("rule_id")),
        )
    )
    named_people = parsed.select("question_id", F.posexplode("people").alias("pos", "driver_id"))
    known_people = stage(named_people.join(store.people, "driver_id"), "known-people")
    people_lines = known_people.select(
        *_line(
            3, c("pos"),
            _text(c("driver_id"), " ", c("name"), ", joined ", c("joining_date"), ", home hub ", c("home_hub"),
                  ". Contact details are masked (", c("phone_masked"), ")."),
            _text("roster:", c("source_row")),
        )
    )
    about_service = parsed.filter(F.array_contains("intents", "maintenance")).select("question_id")
    asked = vehicles.join(about_service, "question_id", "left_semi")
    # History is reduced to its asked vehicles and their last entries before it meets the questions.
    log = store.history.join(asked.select("reg_canon").distinct(), "reg_canon", "left_semi")
    sizes = log.groupBy("reg_canon").agg(F.count(F.lit(1)).alias("n"))
    size_lines = asked.join(sizes, "reg_canon").select(
        *_line(4, c("pos"), _text(c("n"), " maintenance entries on record, most recent first:"), F.lit(None).cast("string"))
    )
    last = topk_per_key(
        log, ["reg_canon"], [c("date").desc_nulls_last(), c("odometer_km").desc_nulls_last(), *[c(k) for k in ("mechanic", "notes")]],
        MAX_HISTORY_LINES,
    )
    log_lines = asked.join(last, "reg_canon").select(
        *_line(5, c("pos") * 10 + c("rank"), _text("  ", c("date"), "  ", c("odometer_km"), " km  ", c("mechanic"), ": ", c("notes")),
               _text("history:", c("reg_canon"), ":", c("date")))
    )
    rule_hits = stage(search_rules(parsed, rules), "rule-hits")
    by_id = {r.id: r for r in rules}
    said = reduce(
        lambda acc, r: F.when(c("rule_id") == r.id, F.lit(f"{r.id} - {r.name}: {r.reason or r.effect}. \"{r.quote}\"" + ("" if r.implemented is not False else " [not enforced]"))).otherwise(acc),
        by_id.values(), F.lit(None).cast("string"),
    )
    rule_lines = rule_hits.select(*_line(6, c("pos"), said, _text("rules#", c("rule_id"))))
    found = vehicles.select("question_id").unionByName(rule_hits.select("question_id")).unionByName(known_people.select("question_id"))
    wants_docs = parsed.filter(F.size("parties") > 0).unionByName(
        parsed.filter(F.size("parties") == 0).join(found, "question_id", "left_anti")
    )
    docs = search_documents(stage(wants_docs, "wants-documents"), store.documents, index=store.index)
    cited = stage(docs.join(parsed.select("question_id", "keywords"), "question_id"), "cited")
    doc_lines = cited.join(document_snippets(cited, store.documents), ["doc_id", "keywords"]).select(
        *_line(7, c("pos"), _text(c("doc_id"), ": ", c("snippet")), _text("doc:", c("doc_id")))
    )
    lines = [vehicle_lines, conflict_lines, people_lines, size_lines, log_lines, rule_lines, doc_lines]
    return reduce(DataFrame.unionByName, lines)


def answer_questions(parsed: DataFrame, store: Store, rules: Sequence[Rule]) -> DataFrame:
    """One row per question: sufficient, answer, citations.

    Questions about a current location are refused before anything is fetched for them. What an answer
    can hold is limited section by section, so collecting its lines is safe.
    """
    elsewhere = F.array_contains("intents", "location")
    lines = evidence(parsed.filter(~elsewhere), store, rules)
    grouped = lines.groupBy("question_id").agg(
        F.array_sort(F.collect_list(F.struct("section", "pos", "line", "source"))).alias("l")
    )
    told = F.array_join(F.transform("l", lambda x: x["line"]), "\n")
    sources = F.array_compact(F.transform("l", lambda x: x["source"]))
    return parsed.join(grouped, "question_id", "left").select(
        "question_id", F.col("l").isNotNull().alias("sufficient"),
        F.when(elsewhere, F.lit(REFUSED_LOCATION)).otherwise(F.coalesce(told, F.lit(REFUSED_NOTHING))).alias("answer"),
        F.coalesce(sources, F.array().cast("array<string>")).alias("citations"),
    )

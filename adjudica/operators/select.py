"""Choosing the best eligible candidate per record without pairing records with candidates.

An exclusion rule tests some keys of the record and some of the candidate. Each side is therefore
summed up in a signature, one letter per rule: ``T`` its part holds, ``F`` it does not, ``M`` an
input is missing. Candidates of a pool that share a day, a signature and a preference value are
interchangeable, so they become one class with a count and its first few ids; records that share a
pool, a day and a signature become one profile. Only classes and profiles meet, and their numbers
depend on the rules and the calendar, not on how many records or candidates there are. What a record
must not choose, its own subject, is taken out of its profile's answer afterwards.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adjudica.operators.lookup import topk_per_key
from adjudica.operators.rules import match_condition
from adjudica.rulebook import CANDIDATE_KEYS, KEY_KINDS, Rule, active

MAX_REJECTED = 8


def exclusion_rules(rules: Sequence[Rule], step: str = "select_vehicle", effect: str = "exclude_vehicle") -> list[Rule]:
    """The rules of the step that can exclude a candidate, in order."""
    return [r for r in active(rules, step) if r.effect == effect]


def side_signature(
    rules: Sequence[Rule], ctx: Mapping[str, Column], candidate: bool,
    candidate_keys: Sequence[str] = tuple(CANDIDATE_KEYS), kinds: Mapping[str, str] = KEY_KINDS,
) -> Column:
    """One letter per rule for one side's share of its conditions."""
    letters = []
    for rule in rules:
        mine = {k: s for k, s in rule.when.items() if (k in candidate_keys) == candidate}
        absent, holds = F.lit(False), F.lit(True)
        for key, spec in mine.items():
            value = ctx.get(key, F.lit(None).cast("string"))
            absent = absent | value.isNull()
            holds = holds & match_condition(spec, value, kinds[key])
        letters.append(F.when(absent, "M").when(holds, "T").otherwise("F"))
    return F.concat(*letters) if letters else F.lit("")


def tested_keys(rules: Sequence[Rule], candidate_keys: Sequence[str] = tuple(CANDIDATE_KEYS)) -> list[str]:
    """The candidate keys the rules test, in order of first use."""
    return list(dict.fromkeys(k for r in rules for k in r.when if k in candidate_keys))


def gap_flags(rules: Sequence[Rule], ctx: Mapping[str, Column]) -> Column:
    """One digit per tested candidate key: 1 where the candidate lacks it."""
    flags = [F.when(ctx[k].isNull(), "1").otherwise("0") for k in tested_keys(rules)]
    return F.concat(*flags) if flags else F.lit("")


def _letter(sig: Column, i: int) -> Column:
    return F.substring(sig, i + 1, 1)


def fired(record_sig: Column, candidate_sig: Column, i: int) -> Column:
    """Whether rule ``i`` excludes the candidate."""
    return (_letter(record_sig, i) == "T") & (_letter(candidate_sig, i) == "T")


def unknown(record_sig: Column, candidate_sig: Column, i: int) -> Column:
    """Whether rule ``i`` could not be evaluated, which blocks the candidate just the same."""
    return (_letter(record_sig, i) == "M") | (_letter(candidate_sig, i) == "M")


def blocked(record_sig: Column, candidate_sig: Column, n: int) -> Column:
    """Whether any of the ``n`` rules excludes the candidate or could not be evaluated."""
    hits = [fired(record_sig, candidate_sig, i) | unknown(record_sig, candidate_sig, i) for i in range(n)]
    return reduce(lambda a, b: a | b, hits, F.lit(False))


def outcome_text(record_sig: Column, candidate_sig: Column, n: int) -> Column:
    """One letter per rule for the pair: ``M`` not evaluated, ``T`` fired, ``F`` neither."""
    letters = [
        F.when(unknown(record_sig, candidate_sig, i), "M")
        .when(fired(record_sig, candidate_sig, i), "T").otherwise("F")
        for i in range(n)
    ]
    return F.concat(*letters) if letters else F.lit("")


def candidate_classes(
    candidates: DataFrame, pool: str, day: str, cid: str, preference: str, sig: str = "cand_sig",
    max_rejected: int = MAX_REJECTED,
) -> DataFrame:
    """One row per (pool, day, signature, preference): how many candidates, and its first ids.

    It keeps as many ids as a list of ``max_rejected`` can use besides the record's own candidate.

    The signature column holds the rule letters, then the gap flags.
    """
    keys = [pool, day, sig, preference]
    base = candidates.select(
        pool, day, sig, F.coalesce(F.col(preference).cast("long"), F.lit(0)).alias(preference), cid
    )
    sizes = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    heads = (
        topk_per_key(base, keys, [F.col(cid)], max_rejected + 1, "__rank")
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(cid)).alias("ids"))
    )
    return sizes.join(heads, keys)


def profile_answers(
    profiles: DataFrame, classes: DataFrame, n_rules: int, pool: str, day: str, preference: str,
    record_sig: str = "rec_sig", prefer: str = "prefer", max_rejected: int = MAX_REJECTED,
) -> DataFrame:
    """Per profile: counts, blocks per rule, its two best eligible candidates and its first rejected ones."""
    keys = [pool, day, record_sig, prefer]
    r, c = F.col(record_sig), F.col("cand_sig")

    def least(of: Column, k: int) -> Column:
        return F.slice(F.array_sort(F.flatten(F.collect_list(of))), 1, k)

    # Classes that differ in the preference only are judged alike. Their ids are in order: only the first two can be the best two.
    two = lambda wish: F.transform(F.slice("ids", 1, 2), lambda i: F.struct(wish.alias("wish"), i.alias("cid"), F.col(preference).alias("__pref")))
    judged = classes.groupBy(pool, day, "cand_sig").agg(
        F.sum("n").alias("n"), least(F.col("ids"), max_rejected + 1).alias("ids"),
        least(two(F.lit(0).cast("long")), 2).alias("__first"), least(two(-F.col(preference).cast("long")), 2).alias("__newest"),
    )
    # Joins here are by merge: these sides pack so well that they look small enough to broadcast, and are not.
    pairs = profiles.select(*keys).distinct().join(judged.hint("merge"), [pool, day]).withColumn("__blocked", blocked(r, c, n_rules))
    eligible = F.when(~F.col("__blocked"), F.when(F.col(prefer), F.col("__newest")).otherwise(F.col("__first")))
    refused = F.when(F.col("__blocked"), F.transform("ids", lambda i: F.struct(i.alias("cid"), c.alias("sig"))))
    found = pairs.groupBy(*keys).agg(
        F.sum("n").alias("n_considered"),
        F.sum(F.when(~F.col("__blocked"), F.col("n")).otherwise(0)).alias("n_eligible"),
        *[
            F.sum(F.when(fired(r, c, i), F.col("n")).otherwise(0)).alias(f"n_fired_{i}")
            for i in range(n_rules)
        ],
        *[
            F.sum(F.when(unknown(r, c, i), F.col("n")).otherwise(0)).alias(f"n_unknown_{i}")
            for i in range(n_rules)
        ],
        least(eligible, 2).alias("__best"), least(refused, max_rejected + 1).alias("__rejected"),
    )
    told = F.transform("__rejected", lambda x: F.struct(
        x["cid"].alias("cid"), outcome_text(r, x["sig"], n_rules).alias("outcome"), x["sig"].substr(F.lit(n_rules + 1), F.length(x["sig"])).alias("gaps"),
    ))
    return found.withColumn("__rejected", told)


def select_top1(
    records: DataFrame, answers: DataFrame, n_rules: int, pool: str, day: str,
    subject: str, subject_sig: str, subject_in_pool: str,
    record_sig: str = "rec_sig", prefer: str = "prefer", max_rejected: int = MAX_REJECTED,
) -> DataFrame:
    """Every record with its choice, counts, blocks per rule and first rejected candidates.

    Adds ``replacement``, ``replacement_pref``, ``n_considered``, ``n_eligible``, ``rejected``
    (array of struct(cid, outcome, gaps)), ``fired_counts`` and ``unknown_counts`` (one number per rule).
    """
    keys = [pool, day, record_sig, prefer]
    joined = records.join(answers.hint("merge"), keys, "left")
    r, s, inside = F.col(record_sig), F.col(subject_sig), F.coalesce(F.col(subject_in_pool), F.lit(False))

    def less(name: str, hit: Column) -> Column:
        return F.coalesce(F.col(name), F.lit(0)) - F.when(inside & hit, 1).otherwise(0)

    others = F.filter("__best", lambda b: F.col(subject).isNull() | (b["cid"] != F.col(subject)))
    top = F.try_element_at(others, F.lit(1))
    rest = F.filter("__rejected", lambda x: F.col(subject).isNull() | (x["cid"] != F.col(subject)))
    empty = F.array().cast("array<struct<cid:string,outcome:string,gaps:string>>")
    return joined.withColumns(
        {
            "replacement": top["cid"],
            "replacement_pref": top["__pref"],
            "rejected": F.coalesce(F.slice(rest, 1, max_rejected), empty),
            "fired_counts": F.array(
                *[less(f"n_fired_{i}", fired(r, s, i)) for i in range(n_rules)]
            ),
            "unknown_counts": F.array(*[less(f"n_unknown_{i}", unknown(r, s, i)) for i in range(n_rules)]),
            "n_eligible": less("n_eligible", ~blocked(r, s, n_rules)),
            "n_considered": less("n_considered", F.lit(True)),
        }
    ).drop(
        "__best", "__rejected", *[f"n_fired_{i}" for i in range(n_rules)],
        *[f"n_unknown_{i}" for i in range(n_rules)],
    )


def block_names(rules: Sequence[Rule], fired_counts: Column, unknown_counts: Column, counted: bool) -> Column:
    """The rules that blocked anything, sorted, joined by commas; with ``x<n>`` if ``counted``."""
    parts = []
    for i, rule in enumerate(rules):
        for counts, label in ((fired_counts, rule.id), (unknown_counts, f"{rule.id}(no data)")):
            n = counts[i]
            text = F.concat(F.lit(f"{label} x"), n.cast("string")) if counted else F.lit(label)
            parts.append(F.when(n > 0, F.struct(F.lit(label).alias("label"), text.alias("text"))))
    hits = F.array_sort(F.array_compact(F.array(*parts)))
    return F.array_join(F.transform(hits, lambda h: h["text"]), ", ")


def nearest_eligible(
    records: DataFrame, pools: DataFrame, distances: DataFrame, origin: str, day: str, key: str
) -> DataFrame:
    """Per record the nearest pool with an eligible candidate, given a distance table.

    ``pools`` holds (pool, day, key) with ``n_eligible``; ``distances`` holds (from_pool, to_pool, km).
    The search runs once per distinct (origin, day, key), not per record.
    """
    asks = records.select(origin, day, key).distinct()
    able = pools.filter("n_eligible > 0").select(F.col("pool").alias("to_pool"), day, key)
    reach = asks.join(distances, F.col(origin) == F.col("from_pool")).drop("from_pool")
    best = (
        reach.join(able, ["to_pool", day, key])
        .groupBy(origin, day, key)
        .agg(F.min(F.struct("km", "to_pool")).alias("__near"))
        .select(origin, day, key, F.col("__near.to_pool").alias("nearest_pool"), F.col("__near.km").alias("nearest_km"))
    )
    return records.join(best, [origin, day, key], "left")

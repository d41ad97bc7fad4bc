import random

from pyspark.sql import functions as F

from adjudica.operators import asof, dedupe, resolve, select
from adjudica.operators.checks import check_replay

FIELDS = ["vid", "model", "year"]


def fold(rows):
    """Merging rows one after the other, writing each disagreement over the last one of its field."""
    merged, conflicts = {}, {}
    for r in rows:
        key = r["k"]
        prior = merged.get(key)
        if prior is None:
            merged[key] = dict(r)
            continue
        new_wins = r["vid"] is not None and prior["vid"] is None
        top, other = (r, prior) if new_wins else (prior, r)
        for f in FIELDS:
            if top[f] is not None and other[f] is not None and top[f] != other[f]:
                conflicts[(key, f)] = (str(top[f]), str(other[f]))
        out = dict(top)
        for f in FIELDS:
            if out[f] is None:
                out[f] = other[f]
        merged[key] = out
    return merged, conflicts


def test_resolution_and_conflicts_match_a_sequential_fold(spark):
    rng = random.Random(7)
    pick = lambda *v: rng.choice(v)
    rows = [
        {"k": f"K{rng.randrange(60)}", "vid": pick(None, None, "A", "B"), "model": pick(None, "x", "y"), "year": pick(None, 2019, 2020, 2021), "row": i}
        for i in range(400)
    ]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], "k string, vid string, model string, year int, row int")
    merged, conflicts = fold(rows)
    got = resolve.resolve_entities(df, "k", "vid", "row", FIELDS)
    assert {r["k"]: tuple(r[f] for f in FIELDS) for r in got.collect()} == {k: tuple(m[f] for f in FIELDS) for k, m in merged.items()}
    found = resolve.field_conflicts(df, got, "k", "row", FIELDS).collect()
    assert {(r["k"], r["field"]): (r["winner"], r["loser"]) for r in found} == conflicts


def test_dedupe_keeps_null_keys_and_reports_the_rest(spark):
    rows = [("a", 3), ("a", 1), (None, 2), (None, 4), ("b", 5), ("a", 6)]
    df = spark.createDataFrame(rows, "k string, pos int")
    kept = dedupe.dedupe_first(df, ["k"], ["pos"])
    assert sorted((str(r["k"]), r["pos"]) for r in kept.collect()) == [("None", 2), ("None", 4), ("a", 1), ("b", 5)]
    assert sorted(r["pos"] for r in dedupe.dedupe_report(df, ["k"], ["pos"]).collect()) == [3, 6]
    plan = kept._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan
    strict = dedupe.insert_ignore(df, ["k"], ["pos"], null_distinct=False)
    assert sorted(r["pos"] for r in strict.collect()) == [1, 2, 5]
    stored = spark.createDataFrame([("a", 0)], "k string, pos int")
    assert sorted(r["pos"] for r in dedupe.insert_ignore(df, ["k"], ["pos"], stored).collect()) == [2, 4, 5]
    assert sorted((str(r["k"]), r["pos"]) for r in dedupe.upsert_last(df, ["k"], ["pos"], stored).collect()) == [("None", 4), ("a", 6), ("b", 5)]
    shuffled = spark.createDataFrame(rows[::-1], "k string, pos int")
    assert check_replay(kept, dedupe.dedupe_first(shuffled, ["k"], ["pos"])).first()["same"]


def test_asof_forms_agree_and_keep_the_boundary_day(spark):
    history = spark.createDataFrame(
        [("v", "2026-01-01", "brake"), ("v", "2026-01-10", "oil"), ("v", "2026-01-10", "oil"), ("v", "2026-02-01", "brake"), ("w", None, "oil")],
        "k string, day string, note string",
    ).withColumn("day", F.to_date("day"))
    probes = spark.createDataFrame(
        [("v", "2025-12-31"), ("v", "2026-01-01"), ("v", "2026-01-15"), ("v", "2026-02-01"), ("v", "2026-01-15"), ("w", "2026-01-01"), (None, "2026-01-01")],
        "k string, at string",
    ).withColumn("at", F.to_date("at"))
    predicates = {"any": F.lit(True), "brake": F.col("note") == "brake"}
    rows = [{tuple(r) for r in how(probes, history, "k", "at", "day", predicates).collect()} for how in (asof.asof_latest, asof.asof_join)]
    assert rows[0] == rows[1]
    text = {(r[0], str(r[1])): (str(r[2]), str(r[3])) for r in rows[0]}
    assert text[("v", "2026-01-01")] == ("2026-01-01", "2026-01-01")
    assert text[("v", "2026-01-15")] == ("2026-01-10", "2026-01-01")
    assert text[("v", "2025-12-31")] == ("None", "None") == text[("w", "2026-01-01")]


def test_sentinels_differ_from_unknown(spark):
    df = spark.createDataFrame([("2026-01-01",), (None,)], "last string").select(F.to_date("last").alias("last"), F.to_date(F.lit("2026-01-08")).alias("at"))
    got = df.select(
        asof.days_past_due(F.col("last"), F.col("at"), 90), asof.days_since_event(F.col("last"), F.col("at"), 99999),
        asof.active_within(F.col("last"), F.col("at"), 7),
    ).collect()
    assert [tuple(r) for r in got] == [(-83, 7, True), (None, 99999, False)]


def test_previous_in_sequence_crosses_buckets(spark):
    rng = random.Random(3)
    rows = [(rng.choice("pq"), f"2026-01-{rng.randrange(1, 20):02d} {rng.randrange(24):02d}:00:00", i, rng.choice([None, "x", "y", "z"])) for i in range(300)]
    df = spark.createDataFrame(rows, "p string, ts string, tie int, v string").withColumn("ts", F.to_timestamp("ts"))
    got = {r["tie"]: r["previous"] for r in asof.previous_in_sequence(df, "p", "ts", "tie", "v").collect()}
    want, last = {}, {}
    for p, ts, tie, v in sorted(rows, key=lambda r: (r[1], r[2])):
        want[tie] = last.get(p)
        last[p] = v
    assert got == want


def test_a_hot_pool_is_answered_by_classes(spark):
    """Two thousand candidates of one pool and day reach the profiles as a handful of classes."""
    candidates = spark.range(2000).selectExpr(
        "'hub' as pool", "'d' as day", "concat('V', lpad(cast(id as string), 5, '0')) as cid", "2015 + id % 3 as year", "case when id % 2 = 0 then 'T0' else 'F0' end as cand_sig"
    )
    classes = select.candidate_classes(candidates, "pool", "day", "cid", "year")
    assert classes.count() == 6 and classes.agg(F.sum("n")).first()[0] == 2000
    assert classes.filter(F.size("ids") > 9).count() == 0
    profiles = spark.createDataFrame([("hub", "d", "T", True), ("hub", "d", "T", False)], "pool string, day string, rec_sig string, prefer boolean")
    answers = select.profile_answers(profiles, classes, 1, "pool", "day", "year")
    records = profiles.crossJoin(spark.createDataFrame([("V00001",), ("V00005",), (None,)], "subject string")).selectExpr(
        "*", "'F0' as own_sig", "subject is not null as inside"
    )
    chosen = select.select_top1(records, answers, 1, "pool", "day", "subject", "own_sig", "inside")
    got = {(r["prefer"], r["subject"]): (r["replacement"], r["n_considered"], r["n_eligible"], len(r["rejected"])) for r in chosen.collect()}
    assert got[(False, None)] == ("V00001", 2000, 1000, 8)
    assert got[(False, "V00001")] == ("V00003", 1999, 999, 8)
    assert got[(True, None)] == ("V00005", 2000, 1000, 8)
    assert got[(True, "V00005")] == ("V00011", 1999, 999, 8)


def test_choices_are_joined_without_broadcast_and_ranked_per_signature(spark):
    # Ids of one day in classes of two signatures and several years; sides that pack well must not be broadcast.
    rows = [("p", "d", "F0" if k % 2 else "T0", 2015 + k % 3, 1, [f"v{k:02}"]) for k in range(30)]
    classes = spark.createDataFrame(rows, "pool string, day string, cand_sig string, year long, n long, ids array<string>")
    records = spark.createDataFrame([("p", "d", "T", True, "v01"), ("p", "d", "T", False, "v00")], "pool string, day string, rec_sig string, prefer boolean, own string")
    answers = select.profile_answers(records, classes, 1, "pool", "day", "year")
    got = select.select_top1(records.withColumns({"own_sig": F.lit("F0"), "inside": F.lit(True)}), answers, 1, "pool", "day", "own", "own_sig", "inside")
    assert "BroadcastHashJoin" not in got._jdf.queryExecution().executedPlan().toString()
    newest, first = got.orderBy(F.col("prefer").desc()).collect()
    assert (newest["replacement"], newest["replacement_pref"]) == ("v05", 2017) and (first["replacement"], first["replacement_pref"]) == ("v01", 2016)
    assert [x["cid"] for x in newest["rejected"]] == [f"v{k:02}" for k in range(0, 16, 2)] and newest["rejected"][0]["outcome"] == "T"
    assert [x["cid"] for x in first["rejected"]] == [f"v{k:02}" for k in range(2, 18, 2)] and first["n_eligible"] == 14

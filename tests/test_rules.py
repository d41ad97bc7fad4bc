import pytest

from adjudica import rulebook as R
from adjudica.operators import rules

CONTEXT = """month_in int, client_is string, km_from_origin double, route_touches array<string>, route_is_hill boolean,
 route_east_of_lucknow boolean, dest_hub string, is_night_dispatch boolean, driver_months_tenure int, vehicle_bs_stage string,
 vehicle_year int, vehicle_has_heater boolean, vehicle_days_past_service int, vehicle_brake_work_days int,
 vehicle_has_active_jugaad boolean, vehicle_last_client_incident string"""
BASE = (1, "internal", 47.0, ["delhi", "jaipur"], False, False, "jaipur", False, 12, "bs4", 2021, True, 0, 99999, False, None)


def judge(spark, context, step="select_vehicle", book=R.DEFAULT_RULES):
    df = spark.createDataFrame([context], CONTEXT)
    return rules.evaluate_rules(df, book, step).select("verdict.*").first()


def change(**kw):
    names = [part.split()[0] for part in CONTEXT.replace("\n", " ").split(", ")]
    return tuple(kw.get(n, v) for n, v in zip(names, BASE))


def matched(v):
    return [m["rule_id"] for m in v["matched"]]


def test_winter_rule_and_its_season(spark):
    v = judge(spark, BASE)
    assert matched(v) == ["R-BS4-NCR-WINTER", "R-ORIGIN-50KM"] and v["excluded"] and v["unevaluated"] == []
    assert not judge(spark, change(month_in=5))["excluded"]


@pytest.mark.parametrize("km, rule", [(50.0, "R-ORIGIN-50KM"), (50.1, "R-ORIGIN-BEYOND-50KM"), (None, None)])
def test_sourcing_boundary(spark, km, rule):
    v = judge(spark, change(month_in=5, km_from_origin=km))
    assert matched(v) == ([rule] if rule else [])
    assert [u["rule_id"] for u in v["unevaluated"]] == ([] if rule else ["R-ORIGIN-50KM", "R-ORIGIN-BEYOND-50KM"])


def test_missing_input_is_unevaluated_even_if_ruled_out_otherwise(spark):
    v = judge(spark, change(month_in=7, route_is_hill=False, vehicle_has_heater=None))
    assert [(u["rule_id"], u["missing_keys"]) for u in v["unevaluated"]] == [("R-HILL-HEATER", ["vehicle_has_heater"])]
    assert not v["excluded"]
    v = judge(spark, change(client_is=None))
    assert [u["rule_id"] for u in v["unevaluated"]] == ["R-ORION-NEWEST"]


def test_empty_when_always_matches_and_inactive_rules_are_silent(spark):
    book = [R.Rule("A", "classify", 1, {}, "message_constraint", "q", value="v"), R.Rule("B", "classify", 9, {}, "set_sla_hours", "q", value="1", implemented=False)]
    assert matched(judge(spark, BASE, "classify", book)) == ["A"]
    with pytest.raises(ValueError):
        judge(spark, BASE, "nonsense")


def test_priority_then_id_orders_matches_and_first_effect(spark):
    book = [R.Rule(i, "classify", p, {}, "set_sla_hours", "q", value=i) for i, p in (("b", 5), ("a", 5), ("c", 9))]
    df = rules.evaluate_rules(spark.createDataFrame([BASE], CONTEXT), book, "classify")
    assert matched(df.select("verdict.*").first()) == ["c", "a", "b"]
    assert df.select(rules.first_effect("verdict", "set_sla_hours").alias("e")).first()["e"]["value"] == "c"
    assert df.select(rules.first_effect("verdict", "adjust_eta_pct").alias("e")).first()["e"] is None


def test_compiled_and_table_forms_agree(spark):
    contexts = [
        change(month_in=m, vehicle_bs_stage=s, route_is_hill=h, vehicle_brake_work_days=b, vehicle_has_heater=t, client_is=c, vehicle_year=y)
        for m in (1, 5, None) for s in ("BS4", None) for h in (True, False) for b in (29, 30, None) for t in (False, None) for c in ("orion_pharma", None) for y in (2019, 2020)
    ]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(contexts)], "id int, " + CONTEXT)
    for step in R.STEPS:
        v = rules.evaluate_rules(df, R.DEFAULT_RULES, step)
        compiled = {(r["id"], m["rule_id"]): ("matched", []) for r in v.collect() for m in r["verdict"]["matched"]}
        compiled |= {(r["id"], u["rule_id"]): ("unevaluated", u["missing_keys"]) for r in v.collect() for u in r["verdict"]["unevaluated"]}
        rows = rules.evaluate_rules_data(df, ["id"], R.rules_table(spark, R.DEFAULT_RULES), R.conditions_table(spark, R.DEFAULT_RULES), step)
        table = {(r["id"], r["rule_id"]): (r["status"], r["missing_keys"]) for r in rows.collect() if r["status"] != "no_match"}
        assert table == compiled


def test_bad_rulebooks_are_refused(spark):
    good = R.Rule("A", "classify", 1, {"month_in": [1]}, "set_sla_hours", "q")
    assert R.check_rules([good]) == [good] and R.check_rules(R.DEFAULT_RULES)
    bad = [
        (R.Rule("A", "nope", 1, {}, "set_sla_hours", "q"), "unknown step"), (R.Rule("A", "classify", 1, {}, "nope", "q"), "unknown effect"),
        (R.Rule("A", "classify", 1, {"colour": "x"}, "set_sla_hours", "q"), "unknown key"),
        (R.Rule("A", "classify", 1, {"month_in": {"lte_": 1}}, "set_sla_hours", "q"), "unknown operator"),
        (R.Rule("A", "classify", 1, {}, "set_sla_hours", None), "missing quote"),
    ]
    for rule, words in bad:
        with pytest.raises(R.RuleError, match=words):
            R.check_rules([rule])
    with pytest.raises(R.RuleError, match="duplicate id"):
        R.check_rules([good, good])
    clean = rules.validate_rules(R.rules_table(spark, R.DEFAULT_RULES), R.conditions_table(spark, R.DEFAULT_RULES))
    assert clean.count() == 0


def test_collected_constraints(spark):
    df = spark.createDataFrame([change(client_is="vertex_retail", dest_hub="Ludhiana")], CONTEXT)
    out = rules.evaluate_rules(df, R.DEFAULT_RULES, "draft_message").select(rules.collect_effects("verdict", "message_constraint").alias("c")).first()["c"]
    assert [c["rule_id"] for c in out] == ["R-VERTEX-GATE-6PM", "R-VERTEX-NOT-FAILED"]

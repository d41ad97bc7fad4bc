"""The queue run: failing records are set apart, versions follow publication, dates keep their time."""

import json

import pytest

from pyspark.sql import functions as F

from adjudica.functions import temporal as T
from adjudica.plans import decision, run
from adjudica.sources import context, files, queue
from adjudica.streaming import incremental


def test_messages_with_personal_data_are_found(spark):
    rows = [("a", "call 9876543210", "x"), ("b", "all is well", "x"), ("c", "fine", "write to some.one@example.com"), ("d", None, None)]
    df = spark.createDataFrame(rows, "ticket_id string, body string, note string")
    df = df.select("ticket_id", "body", F.struct("note").alias("context"), F.array(F.struct("note")).alias("citations"))
    assert {r[0] for r in run.leaking(df).collect()} >= {"a"} and "b" not in {r[0] for r in run.leaking(df).collect()}


def test_newest_publication_wins_whatever_its_name(spark, tmp_path):
    root = str(tmp_path / "ctx")
    for version, value in (("v9", 1), ("v10", 2), ("a", 3)):
        context.publish_context({"t": spark.range(value)}, root, version)
        assert context.read_context(spark, root, "t").count() == value


def test_day_month_year_keeps_its_time(spark):
    texts = ["21/02/2026 22:15", "21-2-2026T07:05:09", "21/02/2026", "21/02/2026xyz", "21/02/2026 25:00"]
    df = spark.createDataFrame([(t,) for t in texts], "v string").select("v", T.wall_clock(T.parse_ts("v")).cast("string").alias("t"))
    assert [df.where(F.col("v") == t).first()["t"] for t in texts] == ["2026-02-21 22:15:00", "2026-02-21 07:05:09", "2026-02-21 00:00:00", None, None]


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("segment,customer\nS1,C1\n")
    (tmp_path / "b.csv").write_text(" Customer ,extra,SEGMENT\nC2,e,\"S,2\"\n")
    df = files.scan_csv(spark, str(tmp_path), ["customer", "segment", "extra"])
    # A column that only some files have is kept, null elsewhere, and refused where it is required.
    assert df.columns == ["customer", "segment", "extra"] and {tuple(r) for r in df.collect()} == {("C1", "S1", None), ("C2", "S,2", "e")}
    assert files.require_columns(df, ["customer", "segment"], "roster") is df
    with pytest.raises(files.GateError, match="extra"):
        files.require_columns(df, ["customer", "extra"], "roster")


def test_csv_headers_may_hold_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,"na\nme",x\n1,"l\n2",3\n4,\n')
    df = files.scan_csv(spark, str(tmp_path), ["id", "x", "na\nme"], multiline=True)
    assert {tuple(r) for r in df.collect()} == {("1", "3", "l\n2"), ("4", "", "")}


def test_late_events_are_not_lost(spark, tmp_path):
    landing = str(tmp_path / "in")
    rows = spark.range(60).selectExpr("id % 40 as k", "timestamp_seconds(1700000000 - id * 86400) as ts")
    rows.repartition(6).write.parquet(landing)
    stream = incremental.read_folder(spark, landing, "k bigint, ts timestamp", per_batch=1)
    got = incremental.distinct_events(stream, ["k"], ["ts"], str(tmp_path / "state"), str(tmp_path / "progress"))
    assert sorted(r["k"] for r in got.collect()) == list(range(40))


def test_one_array_may_hold_a_whole_queue(spark, tmp_path):
    (tmp_path / "q.txt").write_text("[" + ",".join(f'{{"id": "t{k}", "n": {{"truck": {k}}}}}' for k in range(3000)) + ", 5]")
    (tmp_path / "r.txt").write_text('{"rows": [{"id": 1}, {"id": 2}]} trailing')
    got = queue.scan_queue(spark, f"{tmp_path}/*.txt").groupBy("shape").agg(F.count(F.lit(1)), F.count("record")).collect()
    assert {tuple(r) for r in got} == {("json_array", 3001, 3000), ("unrecognised", 1, 0)}


def test_one_odd_record_keeps_the_others(spark, tmp_path):
    good = [f'{{"id": "t{k}", "n": {{"truck": {k}}}}}' for k in range(50)]
    twice = '{"id": "first", "id": "last"}'
    (tmp_path / "a.txt").write_text("\n".join([*good, twice]))
    (tmp_path / "b.txt").write_text("[" + ",".join([*good, twice]) + "]")
    (tmp_path / "c.txt").write_text('{"rows": [' + ",".join([*good, twice]) + "]}")
    (tmp_path / "d.txt").write_text("\n".join([*good, "{broken"]))
    got = queue.scan_queue(spark, f"{tmp_path}/*.txt")
    ids = got.where(F.try_variant_get("record", "$.id", "string") == "last")
    assert {tuple(r) for r in got.groupBy("shape").agg(F.count(F.lit(1)), F.count("record")).collect()} == {
        ("ndjson", 51, 51), ("json_array", 51, 51), ("json_object.rows", 51, 51), ("unrecognised", 1, 0)
    }
    assert ids.count() == 3
    kept = queue.scan_queue(spark, f"{tmp_path}/d.txt", keep_good=True).collect()
    assert len(kept) == 51 and [r["raw"] for r in kept if r["record"] is None] == ["{broken"]


def test_names_that_differ_in_case_only(spark):
    names = F.expr("map('Ticket_ID', 'a', 'ticket id', 'b', 'ID', 'c', 'id', 'd')")
    df = spark.range(1).select(names.alias("fields")).unionByName(spark.range(1).select(F.expr("map('ID', 'c', 'id', 'd')").alias("fields")))
    assert {r["ticket_id"] for r in queue.adapt_columns(df, "fields").collect()} == {"a", "c"}


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()


def test_log_and_queue_are_read_once(spark):
    from adjudica.plans import domain as D
    from adjudica.session import stage

    sf, plans = "/root/testdata/sf0.001", {}

    def keep(df, label):
        plans[label] = _plan(df)
        return stage(df, label)

    decision.decide(D.inputs(spark, sf), keep=keep)
    assert [label for label, plan in plans.items() if "l_shipdate" in plan] == ["history-days"]
    made = run.made_by(D.inputs(spark, sf), D.SALT)
    assert not [name for name, df in made.items() if "o_orderdate" in _plan(df)]


def test_messages_are_drafted_once(spark):
    from adjudica.plans import domain as D

    made = run.made_by(D.inputs(spark, "/root/testdata/sf0.001"), D.SALT)
    assert "Please note" not in _plan(made["comms"]) and made["comms"].count() == made["work_orders"].count()


def test_lists_are_cut_not_read_whole(spark, tmp_path):
    records = [json.dumps({"id": f"t{k}", "n": {"truck": [1, {"x": "a}, {"}]}, "s": 'it\'s "}, {" [ \\'}) for k in range(40)]
    rows = ", 7, ".join(records)
    texts = {
        "a": f"[{rows}]", "b": f'{{"meta": {{"k": [1, 2], "l": "}}"}}, "rows": [{rows}], "z": []}}', "c": f"[{rows}", "d": f"[{rows},, 1]", "e": '{"rows": [ ]}',
        "f": f'{{"rows": [{rows}], "bad": tru}}', "g": "[{'id': 1}]", "h": '{"id": 1, "rows": 5}',
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.txt").write_text(text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        # Only strings in single quotes and objects that wrap no list are read whole.
        _, whole = queue._lists(spark, f"{tmp_path}/*.txt", F.lit(True))
        assert sorted(f[-5] for f in whole) == ["g", "h"]
        got = queue.scan_queue(spark, f"{tmp_path}/*.txt").select(F.substring("source_file", -5, 1).alias("f"), "pos", "shape", F.try_variant_get("record", "$.id", "string").alias("id"), "raw").orderBy("f", "pos").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    shapes = {(r["f"], r["shape"]) for r in got}
    assert shapes == {("a", "json_array"), ("b", "json_object.rows"), ("c", "unrecognised"), ("d", "unrecognised"), ("e", "json_object.rows"), ("f", "unrecognised"), ("g", "json_array"), ("h", "json_single_object")}
    for f in "ab":
        mine = [r for r in got if r["f"] == f]
        assert [r["id"] for r in mine] == [f"t{k // 2}" if k % 2 == 0 else None for k in range(79)] and mine[1]["raw"] == "7"
    assert len([r for r in got if r["f"] not in "ab"]) == 6


def test_names_are_looked_at_once_per_list(spark):
    records = ['{"Ticket No": 1, "x": {"truck": 2, "x": 3}, "y": null}'] * 50 + ['{"id": 1, "truck": {"plate": 4, "id": 5}, "a": {"plate": 6}}', "{}", '{"a": {}, "b": [{"id": 1}]}']
    df = spark.createDataFrame([(r,) for r in records], "t string").select(queue.flatten_once(F.parse_json("t")).alias("fields"))
    shown = {tuple(sorted((k, v) for k, v in r[0].items())) for r in df.select(F.transform_values("fields", lambda k, v: F.to_json(v))).collect()}
    # A value that is no object keeps its name; what lies inside an object comes up, also under the object's own name. Objects come by name.
    assert shown == {(("Ticket No", "1"), ("truck", "2"), ("x", "3"), ("y", "null")), (("id", "1"), ("plate", "6")), (), (("b", '[{"id":1}]'),)}
    matched = queue.matched_fields(df, "fields")
    lines = matched._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = [k for k, line in enumerate(lines) if "Generate" in line][0]
    assert any("Aggregate" in line for line in lines[at + 1 :])
    got = {r["field"]: (r["n_found"], r["n_named"]) for r in matched.collect()}
    assert (got["ticket_id"], got["vehicle"], got["status"]) == ((51, 0), (51, 0), (0, 0))


def test_most_of_a_text_is_ruled_out_by_one_character(spark):
    from adjudica.functions import privacy as P

    assert P._hint(P.DEFAULT_PATTERNS).startswith(r"(?=\d)") and not P._hint([*P.DEFAULT_PATTERNS, P.EMAIL]).startswith("(?=")
    texts = ["+91 98765 43210", "+91-9876543210", "+919876543210", "9876543210", "1234 5678 9012", "123456789012", "HR-12 20110001234", "HR1220110001234", "+91 9876", "12345"]
    df = spark.createDataFrame([(k, f"a, {t}. b") for k, t in enumerate(texts)], "k int, t string")
    assert [r[0] for r in df.orderBy("k").select(P.has_pii("t")).collect()] == [True] * 8 + [False] * 2
    assert df.where(P.mask_text("t", "s") != F.col("t")).count() == 8

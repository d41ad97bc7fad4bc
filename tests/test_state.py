"""Stored state: runs with key filters, merged levels, labels used twice, stored approvals."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from adjudica.operators import outbox, spells
from adjudica.plans import run

SCHEMA = "k string, v int"


def _publish(spark, root, label, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    new = outbox.new_rows(df, outbox.state_for(df, root, "t", SCHEMA, ["k"], label), ["k"], ["v"])
    return outbox.publish_batch({"t": new}, root, label, {"t": ["k"]})


def test_a_batch_opens_only_what_may_hold_its_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(outbox, "FAN_IN", 3)
    root = str(tmp_path / "state")
    for b in range(7):
        assert _publish(spark, root, f"b {b}", [(f"k{b}-{i}", b) for i in range(200)] + [("in all", b)])
    _, rows = outbox._manifest(spark, root)
    assert sorted(r["level"] for r in outbox._runs(rows, "t")) == [0, 1, 1]
    whole = outbox.read_state(spark, root, "t", SCHEMA)
    assert whole.count() == 1401 and whole.select("k").distinct().count() == 1401
    # Three keys of three batches lie in three buckets at most, one unknown key hardly ever in any.
    asked = spark.createDataFrame([("k0-1", 9), ("k3-7", 9), ("k6-9", 9), ("unknown", 9)], SCHEMA)
    opened = outbox.state_for(asked, root, "t", SCHEMA, ["k"])
    assert {"k0-1", "k3-7", "k6-9"} <= {r["k"] for r in opened.collect()} and opened.count() < 1401 / 3
    assert {r["k"] for r in outbox.new_rows(asked, opened, ["k"], ["v"]).collect()} == {"unknown"}


def test_a_label_used_twice_loses_nothing(spark, tmp_path):
    root = str(tmp_path / "state")
    assert _publish(spark, root, "b1", [("a", 1)])
    assert not _publish(spark, root, "b1", [("a", 1)])
    with pytest.raises(ValueError, match="b1"):
        _publish(spark, root, "b1", [("b", 1)])
    assert [r["k"] for r in outbox.read_state(spark, root, "t", SCHEMA).collect()] == ["a"]


def test_approvals_are_stored(spark, tmp_path):
    root = str(tmp_path / "state")
    messages = spark.createDataFrame([(k, "pending", None, None) for k in "abc"], "ticket_id string, status string, approved_by string, sent_at string")
    outbox.publish_batch({"comms": messages}, root, "b0", run.KEYS)
    call = lambda label, *rows: {
        (r["ticket_id"], r["approver"], r["outcome"])
        for r in run.approve(spark, root, spark.createDataFrame(rows, "ticket_id string, approver string, at string").withColumn("at", F.col("at").cast("timestamp")), label).collect()
    }
    first = call("1", ("a", "y", "2024-01-02"), ("a", "x", "2024-01-01"), ("b", " ", "2024-01-01"), ("z", "x", "2024-01-01"))
    assert first == {("a", "x", "sent"), ("a", "y", "already_sent"), ("b", None, "approver_required"), ("z", "x", "unknown_ticket")}
    # An earlier time in a later call changes nothing that was sent; repeating a call neither.
    assert call("2", ("a", "w", "2023-01-01"), ("b", "w", "2024-02-01")) == {("a", "w", "already_sent"), ("b", "w", "sent")}
    assert call("2", ("a", "w", "2023-01-01"), ("b", "w", "2024-02-01")) == {("a", "w", "already_sent"), ("b", "w", "sent")}
    now = run._with_sent(messages, outbox.read_state(spark, root, "sent", run.APPROVED))
    assert {(r["ticket_id"], r["status"], r["approved_by"]) for r in now.collect()} == {("a", "sent", "x"), ("b", "sent", "w"), ("c", "pending", None)}
    assert outbox.read_state(spark, root, "approval_log", outbox.state_schema(spark, root, "approval_log")).count() == 6


def test_spells_count_like_rows_per_day(spark):
    pick, first = random.Random(5), date(2024, 1, 1)
    rows = [(f"m{m}", first + timedelta(d), pick.choice("pq"), pick.choice(["x", "y", None])) for m in range(30) for d in sorted({0, *(pick.randrange(45) for _ in range(pick.randrange(6)))})]
    # A member stays in its pool, as a vehicle in its hub.
    rows = [(m, d, "pq"[int(m[1:]) % 2], s) for m, d, _, s in rows]
    last = first + timedelta(44)
    states = spark.createDataFrame(rows, "member string, day date, pool string, state string")
    runs = spells.spells(states, "member", "day", ["pool", "state"], last)
    asked = [(p, first + timedelta(d)) for p in "pq" for d in (0, 1, 7, 20, 31, 43, 44)]
    got = spells.classes_on_days(runs, spark.createDataFrame(asked, "pool string, day date"), "pool", "day", "member", ["state"], first, last, 3)
    want = {}
    for p, day in asked:
        for m in sorted({r[0] for r in rows}):
            state = max((r[1], r[3] or "") for r in rows if r[0] == m and r[1] <= day)[1] or None
            if "pq"[int(m[1:]) % 2] == p:
                want.setdefault((p, day, state), []).append(m)
    assert {(r["pool"], r["day"], r["state"]): (r["n"], r["ids"]) for r in got.collect()} == {k: (len(v), v[:3]) for k, v in want.items()}


def test_blocks_cover_each_day_once(spark):
    pairs = [(a, b) for a in range(0, 20) for b in range(a, 21)]
    df = spark.createDataFrame(pairs, "a int, b int").withColumn("blocks", spells.blocks(F.col("a"), F.col("b"), 5))
    for r in df.collect():
        days = [d for x in r["blocks"] for d in range(x["block"] << x["level"], (x["block"] + 1) << x["level"])]
        assert sorted(days) == list(range(r["a"], r["b"])) and len(r["blocks"]) <= 10


def test_search_index_equals_contains(spark, tmp_path):
    from adjudica.operators import search_index

    root, pick = str(tmp_path / "index"), random.Random(9)
    word = lambda: "".join(pick.choice("abcdé") for _ in range(pick.randrange(1, 8)))
    docs = [(k, f"Path/{word()}.txt", ", ".join(word().upper() for _ in range(30)) + ("  " if k % 3 else " everywhere")) for k in range(120)] + [(120, None, None), (121, "", "ab")]
    df = spark.createDataFrame(docs, "doc_id int, path string, text string")
    for k in range(3):
        search_index.index_documents(df.where(F.col("doc_id") % 3 == k), root, f"b{k}", texts=("path", "text"), limit=5)
    search_index.index_documents(df.where("doc_id % 3 = 1"), root, "b1", texts=("path", "text"), limit=5)
    terms = {word() for _ in range(150)} | {"everywhere", "path/", "txt", "absent"}
    terms = sorted(t for t in terms if len(t) >= 3)
    got = search_index.term_documents(spark.createDataFrame([(t,) for t in terms], "term string"), root, "int", limit=5)
    want = set()
    for t in terms:
        hits = sorted(i for i, p, x in docs if t in f"{p or ''} {x or ''}".lower())[:5]
        want |= {(t, i, r + 1) for r, i in enumerate(hits)}
    assert {(r["term"], r["doc"], r["rank"]) for r in got.collect()} == want


def test_drift_names_the_rows(spark):
    from adjudica.operators import drift

    rows = [(k, f"v{k}", None if k % 5 else k) for k in range(3000)]
    left = spark.createDataFrame(rows, "k int, v string, w int")
    changed = [(7, "v7", 1), (10, "other", None)]
    right = spark.createDataFrame([r for r in rows if r[0] not in (7, 10, 20)] + changed + [(5000, "new", 1)], "k int, v string, w int").select("w", "v", "k").repartition(5)
    got = {(r["k"], r["change"], tuple(r["columns"])) for r in drift.drift(left, right, ["k"]).collect()}
    assert got == {(7, "changed", ("w",)), (10, "changed", ("v", "w")), (20, "removed", ()), (5000, "added", ())}
    assert drift.drift(left, left.repartition(3), ["k"]).collect() == []
    trees = [drift.hash_tree(df, ["k"]) for df in (left, right.select("k", "v", "w"))]
    assert drift.differing(*trees, 0) == [0] and len(drift.differing(*trees, 2)) <= 4
    empty = left.limit(0)
    assert drift.drift(empty, empty, ["k"]).count() == 0 and drift.drift(empty, left, ["k"]).count() == 3000


def test_longest_alias_wins(spark):
    from adjudica.operators import aliases

    known = spark.createDataFrame([("delhi", "d"), ("new delhi", "nd"), ("agra", "a"), ("agra", "b"), ("", "x"), (None, "y")], "alias string, canonical string")
    texts = spark.createDataFrame([("new delhi",), ("old delhi agra",), ("agra delhi",), ("nothing",), ("",), (None,), ("agra",), ("agra",)], "text string")
    got = {(r["text"], r["canonical"]) for r in aliases.longest_aliases(texts, known).collect()}
    assert got == {("new delhi", "nd"), ("old delhi agra", "d"), ("agra delhi", "d"), ("agra", "a")}


def test_row_numbers_of_split_files(spark, tmp_path):
    from adjudica.sources import files

    rows = {f"f{n}": [f"{k},{'x' * (k % 40)}" for k in range(n)] for n in (1, 700, 2500)}
    for name, lines in rows.items():
        (tmp_path / f"{name}.csv").write_text("k,v\n" + "\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "6000")
    try:
        df = files.scan_csv(spark, str(tmp_path), ["k", "v"], lineage=True)
        got = df.collect()
        assert df.rdd.getNumPartitions() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(got) == 3201 and all(r["source_row"] == int(r["k"]) + 2 and r["v"] == "x" * (int(r["k"]) % 40) for r in got)


def test_a_search_meets_no_more_documents_than_it_returns(spark, tmp_path, monkeypatch):
    from adjudica.operators import retrieve, search_index

    pick = random.Random(5)
    words = [a + b + c for a in "abc" for b in "xyz" for c in ("", "one", "two")]
    texts = {i: " ".join(pick.choices(words, k=6)) for i in range(300)}
    asked = {q: pick.choices(words + ["nowhere"], k=pick.randint(1, 6)) for q in range(40)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    parsed = spark.createDataFrame([(q, [], ks) for q, ks in asked.items()], "question_id long, parties array<string>, keywords array<string>")
    root, limits, find = str(tmp_path / "index"), [], search_index.term_documents
    for k in range(2):
        search_index.index_documents(docs.where(F.col("doc_id") % 2 == k), root, f"b{k}")
    monkeypatch.setattr(search_index, "term_documents", lambda *a: limits.append(a[3]) or find(*a))
    got = {}
    for r in retrieve.search_documents(parsed, docs, index=root).orderBy("question_id", "pos").collect():
        assert r["pos"] == len(got.setdefault(r["question_id"], [])) + 1
        got[r["question_id"]].append(r["doc_id"])
    expected = {}
    for q, terms in asked.items():
        hits = [i for t in terms if len(t) > 2 for i in [i for i in sorted(texts) if t in texts[i]][:40]]
        if hits:
            expected[q] = list(dict.fromkeys(hits))[:4]
    assert got == expected and limits == [4]


def test_questions_are_dealt_evenly(spark):
    from adjudica.plans import queries_ask

    cores = spark.sparkContext.defaultParallelism
    sizes = [r["count"] for r in queries_ask.questions(spark, "/root/testdata/sf0.01").groupBy(F.input_file_name().alias("f")).count().collect()]
    assert len(sizes) == cores and max(sizes) < 2 * min(sizes)


def test_snippets_are_made_once_for_questions_alike(spark):
    from adjudica.functions import text as X
    from adjudica.operators import retrieve

    docs = spark.createDataFrame([(1, "Alpha beta " * 50 + "gamma"), (2, "delta"), (3, None), (4, "unasked")], "doc_id long, text string")
    lists = [[f"w{k}", "gamma"] for k in range(90)] + [["beta"], [], ["none"]]
    rows = [(q, d, lists[q % len(lists)]) for q in range(400) for d in (1, 2, 3, 9)]
    cited = spark.createDataFrame(rows, "question_id long, doc_id long, keywords array<string>")
    key = lambda r: (r["doc_id"], tuple(r["keywords"]), r["snippet"])
    got = [key(r) for r in retrieve.document_snippets(cited, docs, per_copy=7).collect()]
    plain = cited.join(docs, "doc_id").select("doc_id", "keywords", X.snippet("text", "keywords").alias("snippet"))
    assert len(got) == 3 * len(lists) and set(got) == {key(r) for r in plain.collect()}
    again = cited.join(retrieve.document_snippets(cited, docs), ["doc_id", "keywords"])
    assert again.count() == plain.count()

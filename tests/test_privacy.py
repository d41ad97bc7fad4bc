import hashlib
import re

import pytest
from pyspark.sql import functions as F

from adjudica.functions import privacy as P
from adjudica.operators.rules import match_condition

TEXTS = [
    "call +91 98765 43210 or 9876543210 now", "9876543210", "no numbers", "", None, "id 1234 5678 9012 and 123456789012.",
    "glued a9876543210 and 9876543210-x stay", "licence hr-20 20110012345!", "x 9876543210 y 9876543211 z", "12345678901", "5876543210",
    "é9876543210",
]


def token(kind, canonical, width=16):
    return f"[{kind}:{hashlib.sha256(f's|{kind}|{canonical}'.encode()).hexdigest()[:width]}]"


def expected_mask(text):
    if text is None:
        return None
    for p, canonical in (
        (P.LICENCE, lambda m: re.sub("[^A-Z0-9]", "", m.upper())), (P.NATIONAL_ID, lambda m: re.sub(r"\D", "", m)),
        (P.PHONE, lambda m: re.sub(r"\D", "", m)[-10:]),
    ):
        text = re.sub(p.regex, lambda m: token(p.kind, canonical(m.group())), text, flags=re.ASCII)
    return text


def expected_hits(text):
    hits = [(m.start(), p.kind, len(m.group())) for p in P.DEFAULT_PATTERNS for m in re.finditer(p.regex, text or "", flags=re.ASCII)]
    return sorted(hits)


def test_mask_and_find_against_a_plain_loop(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string")
    rows = df.select("i", P.mask_text("t", "s").alias("m"), P.find_pii("t").alias("h"), P.has_pii("t").alias("p")).orderBy("i").collect()
    assert [r["m"] for r in rows] == [expected_mask(t) for t in TEXTS]
    assert [[tuple(x) for x in (r["h"] or [])] for r in rows] == [expected_hits(t) for t in TEXTS]
    assert [r["p"] for r in rows] == [bool(expected_hits(t)) for t in TEXTS]


def test_spellings_share_a_token_and_masking_is_final(spark):
    df = spark.createDataFrame([("+91 98765 43210",), ("9876543210",), (" ",), (None,)], "p string")
    tokens = [r[0] for r in df.select(P.mask_column("p", "PHONE", "s")).collect()]
    assert tokens[0] == tokens[1] == token("PHONE", "9876543210") and tokens[2:] == [None, None]
    twice = spark.createDataFrame([(TEXTS[0],)], "t string").withColumn("a", P.mask_text("t", "s")).withColumn("b", P.mask_text("a", "s")).first()
    assert twice["a"] == twice["b"]
    with pytest.raises(ValueError):
        P.mask_column("p", "PHONE", "s", 10)


def test_gate_names_kinds_and_offsets_but_no_values(spark):
    df = spark.createDataFrame([("ok",), ("call 9876543210",)], "t string")
    with pytest.raises(Exception) as caught:
        P.gate_clean(df, ["t"], "out").collect()
    assert "PII_LEAK in out.t: PHONE@5" in str(caught.value)
    assert "9876543210" not in str(caught.value).split("PII_LEAK")[1][:60]


def test_conditions_never_match_null(spark):
    df = spark.createDataFrame([(5.0, "BS4", True, ["a", "b"]), (None, None, None, None)], "n double, s string, b boolean, a array<string>")
    specs = [
        ({"gte": 5, "lt": 6}, "n", "num", True), ({"gt": 5}, "n", "num", False), ([1, 5], "n", "num", True), ("bs4", "s", "str", True),
        (["bs4"], "s", "str", False), (["BS4"], "s", "str", True), (True, "b", "bool", True), (False, "b", "bool", False),
        (["b", "c"], "a", "array", True), (["c"], "a", "array", False), ({"lt": 9}, "s", "str", False), (5, "n", "num", True),
    ]
    for spec, column, kind, want in specs:
        got = [r[0] for r in df.select(match_condition(spec, F.col(column), kind)).collect()]
        assert got == [want, False], (spec, column)

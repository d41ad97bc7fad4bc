import pytest
from pyspark.sql import functions as F

from adjudica.functions import canonical as C
from adjudica.functions import temporal as T

CASES = {
    C.norm_key: [("CH 40 BH 2290", "CH40BH2290"), ("ch-40-bh-2290", "CH40BH2290"), ("--", None), ("", None), (None, None)],
    C.norm_alias: [
        ("Vertex Retail Pvt. Ltd.", "vertex_retail"), ("ORION", "orion_pharma"), ("Some New Co.", "some_new"),
        ("Foo & Bar", "foo_bar"), ("Ltd.", None), (None, None),
    ],
    C.norm_place: [
        ("Ludhiana WH", "ludhiana"), ("New Delhi (North)", "delhi"), ("old new delhi gate", "delhi"), ("Gurugram", "gurgaon"),
        ("Port Blair", "port_blair"), ("hub", None), ("", None), (None, None),
    ],
    C.norm_prefixed_id: [("drv020", "DRV-020"), ("DRV-20", "DRV-020"), ("drv 12345", "DRV-12345"), ("DRV-01001", "DRV-01001"), ("x20", None), (None, None)],
    C.norm_stage: [("bs-4", "BS4"), ("BS VI", None), ("Bs 6", "BS6"), (None, None)],
    C.norm_enum: [(" high ", "HIGH"), ("Medium", "MEDIUM"), ("urgent", None), (None, None)],
    C.classify_text: [
        ("front tyre awaaz aa rahi thi", "tyre"), ("gear box noise", "gearbox"), ("overheating", "engine"), ("noise", "other"),
        ("brakes", "brake"), ("unbraked", "other"), ("", None), (None, None),
    ],
    C.norm_num: [("92,000 km", 92000.0), ("unknown", None), ("1.5.2", None), ("-3", -3.0), ("12abc3", None), ("45%", 45.0), ("", None), (None, None)],
    C.norm_bool: [("Yes", True), ("haan", True), ("0", False), ("nahi ", False), ("maybe", None), ("", None), (None, None)],
}


@pytest.mark.parametrize("fn", CASES, ids=lambda f: f.__name__)
def test_values_and_idempotence(spark, fn):
    pairs = CASES[fn]
    df = spark.createDataFrame([(i, p[0]) for i, p in enumerate(pairs)], "i int, v string")
    once = df.withColumn("once", fn("v"))
    rows = once.withColumn("twice", fn(F.col("once").cast("string"))).orderBy("i").collect()
    assert [r["once"] for r in rows] == [p[1] for p in pairs]
    # A classification is a label, not a spelling, so only its text classes map to themselves.
    if fn not in (C.classify_text,):
        assert [r["twice"] for r in rows] == [r["once"] for r in rows]


TIMES = [
    ("2026-02-21T04:00:00", "2026-02-20T22:30:00.000Z", "2026-02-21", 4),
    ("2026-05-19", "2026-05-18T18:30:00.000Z", "2026-05-19", 0),
    ("2026-05-19 23:59", "2026-05-19T18:29:00.000Z", "2026-05-19", 23),
    ("Thu, 04 Jun 2026 12:35 +0530", "2026-06-04T07:05:00.000Z", "2026-06-04", 12),
    ("2026-02-21T04:00:00Z", "2026-02-21T04:00:00.000Z", "2026-02-21", 9),
    ("2026-02-21T04:00:00.123+05:30", "2026-02-20T22:30:00.123Z", "2026-02-21", 4),
    ("13/02/2026", "2026-02-12T18:30:00.000Z", "2026-02-13", 0),
    ("2000-01-01", "1999-12-31T18:30:00.000Z", "2000-01-01", 0),
    ("31/02/2026", None, None, None),
    ("not-a-date", None, None, None),
    ("1998-01-01", None, None, None),
    ("2101-01-01", None, None, None),
    ("", None, None, None),
    (None, None, None, None),
]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_times_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(i, t[0]) for i, t in enumerate(TIMES)], "i int, v string")
        parsed = df.select("i", "v", T.parse_ts("v").alias("ts"))
        rows = parsed.select(
            "i", T.utc_text("ts").alias("u"), T.local_date("ts").cast("string").alias("d"), T.local_hour("ts").alias("h"),
            T.parse_date("v").cast("string").alias("p"),
        ).orderBy("i").collect()
        assert [(r["u"], r["d"], r["h"]) for r in rows] == [t[1:] for t in TIMES]
        assert [r["p"] for r in rows] == [t[2] for t in TIMES]
        serial = spark.range(1).select(T.utc_text(T.parse_serial(F.lit(45000.5))).alias("u"), T.parse_serial(F.lit(2026)).alias("n")).first()
        assert (serial["u"], serial["n"]) == ("2023-03-15T06:30:00.000Z", None)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_tenure_and_night(spark):
    df = spark.createDataFrame([("2026-01-01", "2026-06-30"), ("2026-01-01", "2026-07-03"), ("2026-02-01", "2026-01-01"), (None, "2026-01-01")], "a string, b string")
    months = [r[0] for r in df.select(T.tenure_months(F.to_date("a"), F.to_date("b"))).collect()]
    assert months == [5, 6, -2, None]
    hours = spark.range(24).select(T.is_night(F.col("id"))).collect()
    assert [h for h, r in enumerate(hours) if r[0]] == [0, 1, 2, 3, 4, 5, 20, 21, 22, 23]

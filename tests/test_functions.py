import datetime as dt

from pyspark.sql import functions as F

from eventloom.functions import hours as H
from eventloom.functions.keys import email_domain, surrogate_key


def test_surrogate_key_known_digest(spark):
    r = spark.range(1).select(
        surrogate_key(F.lit(1), F.lit(None)).alias("a"),
        surrogate_key(F.lit(None).cast("string"), F.lit(1)).alias("null_first"),
        surrogate_key(F.lit(""), F.lit(1)).alias("empty_first"),
        surrogate_key(F.lit("a-b"), F.lit("c")).alias("c1"),
        surrogate_key(F.lit("a"), F.lit("b-c")).alias("c2"),
    ).first()
    assert r.a == "9902a3dc3ffe71035ef18229afae9987"
    assert r.null_first != r.empty_first          # NULL and '' differ
    assert r.c1 == r.c2                           # separator collision is inherent


def test_email_domain_cases(spark):
    rows = spark.createDataFrame([("a@",), ("a@x@y",), ("A@GMAIL.com",), ("anon-1",), (None,)], "u string")
    got = [r[0] for r in rows.select(email_domain("u")).collect()]
    assert got == ["", "x", "gmail.com", None, None]


def test_hour_key_from_member_names(spark):
    names = ["100011471/100011471_2025-11-09_21#0.json.gz",
             "100011471_2025-11-11_6#xyz.json.gz",
             "2025-11-11_6.json.gz"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(H.hour_key_from_name("n")).collect()]
    assert got == ["2025-11-09_21", "2025-11-11_06", "2025-11-11_06"]


def test_parse_hour_styles(spark):
    df = spark.createDataFrame([("2025-11-10_21",), ("20251110T21",), ("2025-11-10 21",),
                                ("2025-11-11_6",), ("garbage",)], "k string")
    got = [r[0] for r in df.select(H.parse_hour("k")).collect()]
    assert got[:3] == [dt.datetime(2025, 11, 10, 21)] * 3
    assert got[3] == dt.datetime(2025, 11, 11, 6)
    assert got[4] is None


def test_format_and_inclusive_range(spark):
    r = spark.range(1).select(
        F.lit("2025-11-10 21:00:00").cast("timestamp_ntz").alias("s"),
        F.lit("2025-11-10 23:00:00").cast("timestamp_ntz").alias("e"),
    ).select(F.size(H.hour_range("s", "e")).alias("n"), H.format_hour("s").alias("f"),
             H.format_hour("s", "api").alias("a"),
             F.size(H.hour_range("e", "s")).alias("empty")).first()
    assert (r.n, r.f, r.a, r.empty) == (3, "2025-11-10_21", "20251110T21", 0)


def test_default_window():
    start, end = H.default_window(dt.datetime(2025, 11, 11, 9, 41))
    assert end == dt.datetime(2025, 11, 10, 21)
    assert start == dt.datetime(2025, 11, 9, 21)


def test_ntz_literal_ignores_process_time_zone(spark):
    import os
    import time

    old = os.environ.get("TZ")
    os.environ["TZ"] = "America/New_York"
    time.tzset()
    try:
        v = spark.range(1).select(H.ntz_lit(dt.datetime(2024, 1, 15, 3, 0, 0, 5)).alias("t")).first().t
    finally:
        if old is None:
            os.environ.pop("TZ")
        else:
            os.environ["TZ"] = old
        time.tzset()
    assert v == dt.datetime(2024, 1, 15, 3, 0, 0, 5)

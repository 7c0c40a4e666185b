import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF001, oracle, rows_of
from eventloom.operators import coverage as cov
from eventloom.operators import quality as q
from eventloom.plans import catalog as C


def test_check_inventory():
    kinds = [c.kind for c in q.CHECKS]
    assert (kinds.count("not_null"), kinds.count("unique"), kinds.count("relationships")) == (25, 7, 6)


def test_suite_equals_its_oracle_sf0001(w):
    res = C.STEPS["dq_suite"](w)
    assert rows_of(res) == rows_of(oracle("dq_suite"))
    failing = {(r.model, r.column, r.check) for r in res.collect() if r.failures}
    assert {("stg_events", "event_time", "not_null"), ("events", "session_id", "relationships"),
            ("events", "ip_address_id", "relationships")} <= failing


def test_checks_on_hand_made_rows(spark):
    child = spark.createDataFrame([(1, None, "a"), (2, "t", "a"), (3, "t", "b"), (None, "t", "c")],
                                  "amplitude_id long, event_time string, ip string")
    parent = spark.createDataFrame([(1,), (2,)], "amplitude_id long")
    res = {(r.column, r.check): r.failures for r in q.run_suite(
        {"c": child, "p": parent},
        [q.Check("c", "event_time", "not_null"), q.Check("c", "ip", "unique"),
         q.Check("c", "amplitude_id", "relationships", "p", "amplitude_id")]).collect()}
    assert res == {("event_time", "not_null"): 1, ("ip", "unique"): 1,
                   ("amplitude_id", "relationships"): 1}
    assert q.relationships(child, "amplitude_id", parent, "amplitude_id").first().amplitude_id == 3


START, END = "2024-01-01 00:00:00", "2024-01-30 23:00:00"


@pytest.fixture(scope="module")
def ledger(spark):
    ev = C.table(spark, SF001, "events")
    sources = ev.select(F.col("event_type").alias("source"))
    present = cov.present_hours(ev, "event_type", "ts")
    req = cov.required_hours(sources, START, END)
    return sources, present, req


def test_ledger_counts_sf0001(ledger):
    sources, present, req = ledger
    miss = cov.missing_hours(req, present)
    assert req.count() == 3600
    assert cov.covered_hours(req, present).count() == 868
    assert miss.count() == 2732
    assert cov.batch_hours(miss).count() == 637
    assert cov.batch_hours(miss, 2).count() == 1546


def test_batches_match_sequential_definition(spark, ledger):
    """Brute force: walk the sorted missing hours per source, as a loop would."""
    sources, present, req = ledger
    miss = cov.missing_hours(req, present)
    got = {(r.source, r.batch_start, r.batch_end) for r in cov.batch_hours(miss, 3).collect()}
    by_src: dict = {}
    for r in miss.collect():
        by_src.setdefault(r.source, []).append(r.hour)
    want = set()
    for s, hrs in by_src.items():
        hrs.sort()
        start = end = hrs[0]
        n = 1
        for h in hrs[1:]:
            if h == end + dt.timedelta(hours=1) and n < 3:
                end, n = h, n + 1
            else:
                want.add((s, start, end))
                start = end = h
                n = 1
        want.add((s, start, end))
    assert got == want


def test_resume_points(spark):
    sources = spark.createDataFrame([("a",), ("b",), ("c",)], "source string")
    h = lambda x: dt.datetime(2025, 11, 10, x)
    present = spark.createDataFrame([("a", h(21)), ("a", h(22)), ("b", h(22)),
                                     ("c", h(21)), ("c", h(22)), ("c", h(23))],
                                    "source string, hour timestamp_ntz")
    got = {r.source: r.resume_key for r in cov.resume_points(sources, present, h(21), h(23)).collect()}
    assert got == {"a": "20251110T23", "b": "20251110T21", "c": "20251111T00"}


def test_publishable_and_discardable(spark):
    h = lambda x: dt.datetime(2025, 1, 1, x)
    local = spark.createDataFrame([("s", h(1)), ("s", h(2))], "source string, hour timestamp_ntz")
    remote = spark.createDataFrame([("s", h(2)), ("s", h(3))], "source string, hour timestamp_ntz")
    assert [r.hour for r in cov.publishable(local, remote).collect()] == [h(1)]
    assert [r.hour for r in cov.discardable(local, remote).collect()] == [h(2)]


def test_cap_one_is_one_batch_per_hour(spark):
    h = lambda x: dt.datetime(2025, 1, 1, x)
    miss = spark.createDataFrame([("s", h(i)) for i in (1, 2, 3, 5)], "source string, hour timestamp_ntz")
    assert cov.batch_hours(miss, 1).count() == 4
    assert cov.batch_hours(miss).count() == 2


def test_known_empty_hours_unblock_resume(spark):
    sources = spark.createDataFrame([("a",)], "source string")
    h = lambda x: dt.datetime(2025, 11, 10, x)
    present = spark.createDataFrame([("a", h(21)), ("a", h(23))], "source string, hour timestamp_ntz")
    empty = spark.createDataFrame([("a", h(22))], "source string, hour timestamp_ntz")
    assert cov.resume_points(sources, present, h(21), h(23)).first().resume_key == "20251110T22"
    assert cov.resume_points(sources, present, h(21), h(23), empty).first().resume_key == "20251111T00"
    rep = cov.coverage_report(sources, present, h(21), h(23), known_empty=empty).first()
    assert (rep.present_hours, rep.missing_hours, rep.batches) == (3, 0, 0)


def test_reports_equal_their_oracle_in_any_time_zone(spark, w):
    names = ("coverage_report", "resume_points", "hours_missing", "hour_batches_capped", "hour_key_roundtrip", "default_window")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            for name in names:
                assert rows_of(C.STEPS[name](w)) == rows_of(oracle(name)), (zone, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_hours_that_a_time_zone_skips(spark):
    """02:30 on 2024-03-10 does not exist in New York; as wall-clock time it is an hour like any other."""
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        h = lambda x, m=0: dt.datetime(2024, 3, 10, x, m)
        ev = spark.createDataFrame([("a", h(1, 59)), ("a", h(2, 30)), ("a", h(3))], "s string, t timestamp_ntz")
        present = cov.present_hours(ev, "s", "t")
        assert sorted(r.hour for r in present.collect()) == [h(1), h(2), h(3)]
        assert cov.coverage_report(None, present, h(1), h(3)).first().missing_hours == 0
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_empty_range_and_capped_batches(spark, ledger):
    sources, present, _ = ledger
    r = cov.resume_points(sources, present, "2024-02-01 00:00:00", "2024-01-01 00:00:00").collect()
    assert {x.resume_hour for x in r} == {dt.datetime(2024, 2, 1)}
    req = cov.required_hours(sources, START, END)
    miss = cov.missing_hours(req, present)
    for cap in (None, 1, 2, 5):
        want = {x.source: x.n for x in cov.batch_hours(miss, cap).groupBy("source").agg(F.count("*").alias("n")).collect()}
        assert {x.source: x.batches for x in cov.coverage_report(sources, present, START, END, cap).collect()} == want

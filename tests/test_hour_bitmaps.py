import datetime as dt

import pytest

from conftest import oracle, rows_of
from eventloom.operators import coverage as cov
from eventloom.operators import hour_bitmaps as hb
from eventloom.plans import catalog as C


def test_bitmaps_keep_every_hour(spark, tmp_path_spark):
    """Hours before 1970, on bucket borders and years apart; repeats and NULLs do no harm."""
    border = dt.datetime(1970, 1, 1) + dt.timedelta(hours=hb.BUCKET * 15)
    hours = [dt.datetime(1970, 1, 1), dt.datetime(2024, 2, 29, 23), border, border - dt.timedelta(hours=1), border + dt.timedelta(hours=1)]
    rows = [("a", h) for h in hours] + [("b", hours[1]), ("b", None), ("a", hours[1]), (None, hours[2])]
    df = spark.createDataFrame(rows, "source string, hour timestamp_ntz")
    path = tmp_path_spark("bits")
    assert hb.ledger(spark, path).count() == 0
    for _ in range(2):
        hb.record(df, path)
    stored = hb.ledger(spark, path)
    got = sorted(map(tuple, hb.hours(stored).collect()), key=str)
    assert got == sorted({r for r in rows if r[1]}, key=str)
    assert {r.source: r.n_hours for r in hb.counts(stored).collect()} == {"a": 5, "b": 1, None: 1}
    start, end = border - dt.timedelta(hours=3), border + dt.timedelta(hours=3)
    want = cov.missing_hours(cov.required_hours(df.where("source is not null"), start, end), df.where("source is not null"))
    assert sorted(map(tuple, hb.missing(stored.where("source is not null"), start, end).collect())) == sorted(map(tuple, want.collect()))
    assert sorted(r.hour for r in hb.hours(stored.where("source = 'a'"), start, end).collect()) == sorted(hours[2:])


@pytest.mark.parametrize("name", ["hours_missing_stored", "coverage_report_stored", "hours_per_source"])
def test_stored_ledger_equals_the_oracle(w, name):
    assert rows_of(C.STEPS[name](w)) == rows_of(oracle(name))

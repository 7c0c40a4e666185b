"""Raw events rendered once for several landings."""

from eventloom.plans import catalog
from eventloom.sources import landing as land


def test_raw_events_are_built_once_for_landings_and_staging(spark, monkeypatch):
    w, built = catalog.Workspace(spark, "/root/testdata/sf0.001"), []
    monkeypatch.setattr(catalog, "raw_from_events", lambda ev, real=catalog.raw_from_events: built.append(1) or real(ev))
    n = w.raw_lines.count()
    assert w.raw_lines.columns == ["value", land.HOUR_KEY] and w.stg.count() == n and len(built) == 1


def test_events_before_the_mark_by_key_and_by_time(spark, raw_from_json):
    times = ["2024-01-15 02:59:59.9", "2024-01-15 03:00:00", "2023-12-31 23:00:00", "+12024-01-01 00:00:00", "-0044-03-15 12:00:00", None]
    raw = land.with_hour_key(raw_from_json([f'{{"event_time": "{t}"}}' if t else "{}" for t in times]))
    for form in (raw, land.as_lines(raw)):
        assert [catalog._before_mark(form, b).count() for b in (True, False)] == [3, 3]

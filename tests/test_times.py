"""Times read by compiled casts: the rows of lookups path by path."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventloom.operators import staging

ODD_TIMES = ['"2024-01-15 03:00:00.25"', '"2024-01-15T03:00:00"', '"2024-01-15"', '"2024-01-15 03:00:00+05:00"', '"2024-13-15 03:00:00"',
             '"2024-01-15 later"', "2024", "true", "null", '{"a": 1}', '["a-bb-cc d"]', '" 2024-01-15 03:00:00 "', '"+12024-01-15 03:00:00"', '""']


def test_times_are_those_of_path_lookups(raw_from_json):
    raw = raw_from_json([f'{{"uuid": "{i}", "event_time": {t}}}' for i, t in enumerate(ODD_TIMES)] + ['{"uuid": "x"}', "[1]", "3", None])
    rows = lambda how: sorted(((r.uuid or "", r.event_time) for r in staging.parse_events(raw, mode="permissive", lookup=how).select("uuid", F.col("event_time").cast("string")).collect()), key=str)
    assert rows("object") == rows("fields")
    assert ("0", "2024-01-15 03:00:00.25") in rows("object")
    assert "timestamp" not in staging.staging_struct_type()


@pytest.mark.parametrize("time", ["2024", "true", '"2024-13-15 03:00:00"', '{"a": 1}'])
def test_strict_still_raises_on_a_value_that_is_no_time(raw_from_json, time):
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        staging.parse_events(raw_from_json([f'{{"uuid": "u", "event_time": {time}}}'])).select("event_time").collect()


def test_native_variant_times(spark):
    raw = spark.range(1).select(F.expr("to_variant_object(named_struct('uuid', 'u', 'event_time', timestamp_ntz'2024-01-15 03:00:00.5', 'processed_time', date'2024-01-15'))").alias("json_data"))
    for how in ("object", "fields"):
        r = staging.parse_events(raw, lookup=how).first()
        assert (r.event_time, r.processed_time) == (dt.datetime(2024, 1, 15, 3, 0, 0, 500000), dt.datetime(2024, 1, 15))

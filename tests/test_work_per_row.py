"""Work that every row pays for: one walk over an object, one parse of a property text, one grouping of checked values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from eventloom.operators import dimensions as dims
from eventloom.operators import quality
from eventloom.operators.staging import parse_events, staging_as_text
from eventloom.sources.raw import raw_from_events

ODD = ['{"uuid":"a","amplitude_id":"7","app":5.0,"event_id":true,"session_id":null,"city":12,"event_time":"2024-01-05 01:02:03"}',
       '{"uuid":0.00000012,"city":100000000000000000000000,"region":{"x":1},"country":[1],"amplitude_id":-3}',
       '[{"uuid":"in an array"}]', '"text"', "5", "null", "{}", '{"uuid":"é\\n\\"","user_properties":null}']


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def _raw(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "t string").select(F.try_parse_json("t").alias("json_data"))


@pytest.mark.parametrize("mode", ["strict", "permissive"])
@pytest.mark.parametrize("number_type", ["bigint", "decimal(38,0)"])
def test_one_walk_gives_what_lookups_of_each_field_give(spark, mode, number_type):
    raw = _raw(spark, [*ODD, None])
    walked, looked_up = (staging_as_text(parse_events(raw, mode, number_type, lookup=x)) for x in ("object", "fields"))
    assert "object_probe" not in _plan(walked)
    assert [tuple(r) for r in walked.collect()] == [tuple(r) for r in looked_up.collect()]


@pytest.mark.parametrize("bad", ['{"amplitude_id":"x"}', '{"session_id":[1]}', '{"event_id":1e30}', '{"event_time":"never"}'])
def test_strict_still_raises(spark, bad):
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        parse_events(_raw(spark, [ODD[0], bad])).collect()
    assert parse_events(_raw(spark, [bad]), "permissive").drop("event_properties", "user_properties").distinct().collect()[0]["amplitude_id"] is None


def test_a_property_text_is_parsed_once(spark):
    stg = spark.createDataFrame([('{"referrer":"r","k":1}',), ("null",), ("[1]",), (None,)], "event_properties_text string").select(
        "*", F.md5("event_properties_text").alias("event_properties_key"), F.lit(None).cast("string").alias("user_properties_text"),
        F.lit(None).cast("string").alias("user_properties_key"))
    found = dims.event_properties(stg)
    assert _plan(found).lower().count("parsejson") + _plan(found).lower().count("parse_json") == 1
    rows = {r.t: r.referrer for r in found.select(F.to_json("properties_json").alias("t"), "referrer").collect()}
    assert rows == {'{"k":1,"referrer":"r"}': "r", "null": None, "[1]": None}


def test_checked_values_and_parents_meet_without_a_join(spark):
    child = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("a",), ("c",), ("d",), (None,)], "id string")
    checks = [quality.Check("m", "k", "relationships", "p", "id"), quality.Check("m", "k", "unique"), quality.Check("m", "k", "not_null")]
    found = quality.model_check_counts(child, "m", checks, {"p": parent})
    assert _plan(found).count("Join") == 1  # with the listing of checks
    assert {r.check: r.failures for r in found.collect()} == {"relationships": 1, "unique": 1, "not_null": 1}
    empty = quality.model_check_counts(child.limit(0), "m", checks, {"p": parent})
    assert {r.check: r.failures for r in empty.collect()} == {"relationships": 0, "unique": 0, "not_null": 0}


def test_raw_text_is_cut_by_bytes(spark):
    events = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), 2, "größe ≥ 5", 1.0, '{"k": 3}')],
                                   "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    raw = raw_from_events(events)
    assert "octet_length" in _plan(raw)
    row = parse_events(raw).select("event_type", "uuid", "amplitude_id").first()
    assert tuple(row) == ("größe ≥ 5", "u-1", 2)

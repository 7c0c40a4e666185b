import decimal

import pytest
from pyspark.sql import functions as F

from eventloom.operators.staging import STAGING_COLUMNS, parse_events, staging_as_text


def test_staging_has_29_columns_in_order(raw_from_json):
    stg = parse_events(raw_from_json(['{"uuid":"u1"}']))
    assert stg.columns == STAGING_COLUMNS and len(STAGING_COLUMNS) == 29


def test_staging_paths_renames_and_types(raw_from_json):
    line = ('{"$insert_id":"i1","amplitude_id":42,"event_id":7,"session_id":1762808400000,'
            '"event_time":"2025-11-10 21:00:00.123000","uuid":"u-7","extra":1,'
            '"event_properties":{"b":1,"[Amplitude] Page Path":"/p1"},"user_properties":{"plan":2}}')
    r = staging_as_text(parse_events(raw_from_json([line]))).first()
    assert (r.insert_id, r.amplitude_id, r.event_id_raw, r.session_id_raw) == ("i1", 42, 7, 1762808400000)
    assert str(r.event_time) == "2025-11-10 21:00:00.123000"
    assert r.event_properties == '{"[Amplitude] Page Path":"/p1","b":1}'   # canonical, sorted
    assert r.city is None                                                   # missing key -> NULL


def test_modes_on_bad_value(raw_from_json):
    raw = raw_from_json(['{"uuid":"u","amplitude_id":"not a number"}'])
    with pytest.raises(Exception):
        parse_events(raw, mode="strict").collect()
    assert parse_events(raw, mode="permissive").first().amplitude_id is None
    q = parse_events(raw, mode="quarantine").first()
    assert q.amplitude_id is None and q._errors == ["amplitude_id"]


def test_number_type_decimal(raw_from_json):
    raw = raw_from_json(['{"amplitude_id":2.5}', '{"amplitude_id":12345678901234567890123}'])
    got = [r.amplitude_id for r in parse_events(raw, number_type="decimal(38,0)").collect()]
    assert got == [decimal.Decimal(3), decimal.Decimal("12345678901234567890123")]


def test_malformed_line_gives_null_raw(spark, tmp_path_spark):
    from eventloom.sources.raw import read_raw

    p = tmp_path_spark("jsonl")
    spark.createDataFrame([('{"uuid":"a"}',), ("{not json",)], "value string").coalesce(1).write.text(p)
    raw = read_raw(spark, p, via="json")
    assert raw.where(F.col("json_data").isNull()).count() == 1
    assert parse_events(raw).where(F.col("uuid") == "a").count() == 1


def test_struct_extraction_matches_per_path_lookup(raw_from_json):
    from eventloom.operators.staging import STAGING_SPEC, json_path

    lines = ['{"uuid":"a","amplitude_id":1,"City":"x","city":"y","event_properties":{"k":[1,2]}}',
             "123", "[1,2]", '{"uuid":null,"session_id":null}', None]
    raw = raw_from_json(lines)
    fast = staging_as_text(parse_events(raw))
    slow = staging_as_text(raw.select(*[
        F.variant_get("json_data", json_path(k), "bigint" if t == "number" else t).alias(n)
        for n, k, t in STAGING_SPEC]))
    assert fast.exceptAll(slow).count() == 0 and slow.exceptAll(fast).count() == 0
    assert [r.city for r in fast.collect()][0] == "y"          # keys are case-sensitive
    perm = staging_as_text(parse_events(raw_from_json(['{"uuid":"a","amplitude_id":"bad"}']),
                                        mode="permissive")).first()
    assert perm.uuid == "a" and perm.amplitude_id is None      # one bad field, others kept

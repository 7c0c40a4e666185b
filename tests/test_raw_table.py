"""The stored VARIANT table: equal staging, typed sub-columns read, hours replaced."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from conftest import oracle, rows_of
from eventloom.operators import facts
from eventloom.operators.staging import STAGING_COLUMNS, parse_events, staging_as_text
from eventloom.plans import catalog as C
from eventloom.sources import landing as land
from eventloom.sources.raw_table import land_raw_table, read_raw_table


def read_schema(df):
    return re.findall(r"ReadSchema: (.*)", df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")))


@pytest.mark.parametrize("name", ["raw_table_staging", "raw_table_sessions", "raw_table_landed_again"])
def test_queries_equal_their_oracle(w, name):
    assert rows_of(C.STEPS[name](w)) == rows_of(oracle(name))


def test_scan_reads_the_fields_asked_for(w, spark, tmp_path_spark):
    path = tmp_path_spark("raw-table")
    land_raw_table(land.with_hour_key(w.raw), path)
    stg = parse_events(read_raw_table(spark, path), lookup="fields")
    # one typed field: one typed sub-column
    (one,) = read_schema(stg.groupBy("event_type").count())
    assert one == "struct<json_data:struct<0:string>>"
    # the session model: its own fields, of objects the event properties only
    for schema in read_schema(facts.sessions(stg)):
        assert schema.count("variant") == 1 and schema.count(":") - 1 == 11 < len(STAGING_COLUMNS)
    # folders of hours before a date are not read
    late = read_raw_table(spark, path, since=dt.datetime(2024, 1, 20))
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "hour_key" in plan.split("PartitionFilters")[1]
    assert len(late.inputFiles()) <= len(read_raw_table(spark, path).inputFiles())
    hours = {r.hour_key for r in late.select("hour_key").distinct().collect()}
    assert None in hours and min(h for h in hours if h) >= "2024-01-20_00"


def test_odd_values(raw_from_json, spark, tmp_path_spark):
    """Mixed types, roots that are no objects, malformed lines and absent fields."""
    lines = ['{"uuid":"a","amplitude_id":1,"event_time":"2024-01-01 00:00:00","event_properties":{"k":1}}',
             '{"uuid":"b","amplitude_id":"2","event_time":"2024-01-01 00:10:00","event_properties":{"k":"x"}}',
             '{"uuid":7,"amplitude_id":null,"event_time":"2024-01-01 01:00:00"}', "[1,2]", "5", "null", "{}", "not json", None]
    raw = land.with_hour_key(raw_from_json(lines))
    path = tmp_path_spark("odd")
    for _ in range(2):
        land_raw_table(raw, path)
    stored = read_raw_table(spark, path)
    for mode in ("strict", "permissive"):
        got = staging_as_text(parse_events(stored, mode, lookup="fields"))
        want = staging_as_text(parse_events(raw, mode))
        # the second landing adds no untimed row that is there already
        assert rows_of(got.select(*want.columns)) == rows_of(want)
    with pytest.raises(Exception):
        parse_events(raw_from_json(['{"amplitude_id":"no number"}']), lookup="fields").select("amplitude_id").collect()
    assert parse_events(raw_from_json(['{"amplitude_id":"no number"}']), "permissive", lookup="fields").where(F.col("amplitude_id").isNull()).count() == 1


def test_empty_input(raw_from_json, spark, tmp_path_spark):
    path = tmp_path_spark("empty")
    land_raw_table(land.with_hour_key(raw_from_json([None]).limit(0)), path)
    land_raw_table(land.with_hour_key(raw_from_json(["{}"])), path)
    assert parse_events(read_raw_table(spark, path), lookup="fields").count() == 1

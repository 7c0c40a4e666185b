"""Raw events are built once for several passes over them; archives are unpacked by many tasks."""

import os

from pyspark.sql import functions as F

from eventloom.plans import catalog
from eventloom.sources import archives as arch
from eventloom.sources import landing as land
from eventloom.sources.raw import raw_from_events


def _events(spark, path, n=400):
    """Events over three days; some without user, time or properties, some with odd ones."""
    eid = F.col("id")
    (spark.range(n).select(
        F.when(eid != 17, eid).alias("event_id"),
        F.when(eid % 31 != 4, F.expr("timestamp_ntz'2024-01-14 00:00:00' + make_interval(0, 0, 0, 0, 0, id * 10)")).alias("ts"),
        F.when(eid % 7 != 2, eid % 9).alias("user_id"), F.lit("view").alias("event_type"), F.lit(1.0).alias("value"),
        F.when(eid % 13 != 5, F.concat(F.lit('{"k": '), (eid % 5).cast("string"), F.lit("}"))).alias("props"))
     .write.parquet(f"{path}/events.parquet"))
    return catalog.Workspace(spark, path)


def test_landings_pass_over_stored_raw_events(spark, tmp_path_spark):
    w = _events(spark, tmp_path_spark("scale-raw"))
    for before in (True, False):
        plan = catalog._before_mark(w.raw_keyed, before)._jdf.queryExecution().executedPlan().toString()
        assert "events.parquet" not in plan and "Exchange" not in plan
    text = lambda df: sorted((r[0], r[1] or "") for r in df.select(F.to_json("json_data"), "hour_key").collect())
    assert text(w.raw_keyed) == text(land.with_hour_key(w.raw))


def test_raw_events_are_the_objects_of_their_columns(spark, tmp_path_spark):
    from eventloom.sources.raw import adapter_columns

    w = _events(spark, tmp_path_spark("scale-columns"))
    events = w.table("events")
    get = lambda key, kind="string": F.variant_get("json_data", f"$.{key}", kind)
    got = raw_from_events(events).select(get("uuid"), get("event_id", "bigint"), F.to_json(get("event_properties", "variant")), F.to_json(get("user_properties", "variant")))
    want = adapter_columns(events).select("uuid", "event_id_raw", F.to_json(F.parse_json("ep")), F.to_json(F.parse_json("up")))
    rows = lambda df: sorted(str(tuple(r)) for r in df.collect())
    assert rows(got) == rows(want)


def test_archives_are_unpacked_by_many_tasks(spark, tmp_path_spark):
    w, path = _events(spark, tmp_path_spark("scale-archives")), tmp_path_spark("scale-zips")
    arch.write_archives(w.raw, path).write.format("noop").mode("overwrite").save()
    out = tmp_path_spark("scale-unpacked")
    os.makedirs(out)
    rows = arch.unpack_archives(spark, path).select("archive", "member", F.spark_partition_id().alias("task"))
    rows.write.parquet(f"{out}/rows")
    read = spark.read.parquet(f"{out}/rows")
    assert read.count() == w.raw.count()
    assert read.select("task").distinct().count() > 1   # all members went to one task

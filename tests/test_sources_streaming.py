import pytest
from pyspark.sql import functions as F

from eventloom import streaming as stream
from eventloom.operators import facts
from eventloom.functions.hours import trunc_hour
from eventloom.operators.staging import parse_events, with_property_keys
from eventloom.plans import catalog as C
from eventloom.plans import dag
from eventloom.sources import archives as arch
from eventloom.sources import landing as land
from eventloom.sources.files import write_named
from eventloom.sources.raw import read_raw, read_raw_with_hour


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def raw(w):
    """A few hours' worth of the raw events, untimed ones included."""
    ts = F.try_variant_get("json_data", "$.event_time", "timestamp_ntz")
    day = F.lit("2024-01-15").cast("date")
    part = w.raw.where(ts.isNull() | F.to_date(ts).between(day - 1, day))
    return w.written("raw-part", lambda: part)


def staged(raw):
    return with_property_keys(parse_events(raw))


def test_landing_is_idempotent_and_ledger_lists_hours(spark, raw, tmp_path_spark):
    path = tmp_path_spark("land")
    keyed = land.with_hour_key(raw)
    land.land_hours(keyed, path)
    land.land_hours(keyed, path)                      # refetch replaces, never appends
    back = parse_events(read_raw_with_hour(spark, path))
    assert back.count() == raw.count()
    assert back.where(~trunc_hour("event_time").eqNullSafe(F.col("hour"))).count() == 0
    hours = land.landed_hours(spark, path)
    assert hours.count() == keyed.where("hour_key is not null").select("hour_key").distinct().count()
    assert land.land_new_hours(spark, keyed, path) == []   # nothing new to publish
    # a line without an hour is added once and survives later offers
    odd = spark.createDataFrame([('{"uuid":"n1"}',), ('{"uuid":"n2","event_time":"never"}',)], "j string").select(
        F.parse_json("j").alias("json_data"))
    for _ in range(2):
        land.land_new_hours(spark, land.with_hour_key(odd), path)
        land.land_hours(keyed, path)
    back = parse_events(read_raw(spark, path), mode="permissive")
    assert back.count() == raw.count() + 2 and back.where("uuid in ('n1', 'n2')").count() == 2


def test_a_hot_hour_is_written_by_several_tasks(spark, raw, tmp_path_spark):
    path = tmp_path_spark("land-hot")
    hot = raw.crossJoin(spark.range(20)).select("json_data", F.lit("2024-01-15_03").alias("hour_key"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "32k")
    try:
        land.land_hours(hot, path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    assert files.count() > 1 and spark.read.text(path).count() == hot.count()


def test_flat_hour_files(spark, raw, tmp_path_spark):
    path = tmp_path_spark("flat")
    written = {r.file: r.lines for r in land.land_flat_hours(land.with_hour_key(raw), path).collect()}
    assert sum(written.values()) == raw.count() and "2024-01-15_03.jsonl" in written
    back = parse_events(read_raw_with_hour(spark, path))
    assert back.where(~trunc_hour("event_time").eqNullSafe(F.col("hour"))).count() == 0


def test_archives_roundtrip(spark, raw, tmp_path_spark, monkeypatch):
    path = tmp_path_spark("zips")
    written = arch.write_archives(raw, path, buckets=2).collect()
    assert sum(r.lines for r in written) == raw.count()
    stg = parse_events(arch.unpack_archives(spark, path))
    assert stg.count() == raw.count()
    assert stg.where(~trunc_hour("event_time").eqNullSafe(F.col("hour"))).count() == 0


def test_archive_members_are_streamed(spark, tmp_path_spark):
    """A member many batches long comes out in batches, blank and bad lines included."""
    path = tmp_path_spark("zip-long")
    n = 3 * arch.BATCH_LINES + 5
    lines = spark.range(n).select(F.lit("2024-01-01_00-0.zip").alias("file"), F.concat(F.lit('{"uuid":"'), "id", F.lit('"}')).alias("value"),
                                  F.lit("1/1_2024-01-01_0#x.json.gz").alias("member"))
    extra = spark.createDataFrame([("2024-01-01_00-0.zip", v, "1/1_2024-01-01_0#x.json.gz") for v in ("", "{bad")], lines.schema)
    write_named(lines.unionByName(extra), path, zipped=True).collect()
    out = arch.unpack_archives(spark, path)
    assert out.count() == n + 1 and out.where("json_data is null").count() == 1
    assert {r.hour_key for r in out.select("hour_key").distinct().collect()} == {"2024-01-01_00"}


def test_stream_dedupe_keeps_and_counts_late_rows(spark, raw, tmp_path_spark):
    path = tmp_path_spark("sd-src")
    keyed = land.with_hour_key(raw)
    sink, late, ckpt = tmp_path_spark("sd"), tmp_path_spark("sd-late"), tmp_path_spark("sd-ckpt")
    for part in (C._before_mark(keyed, False), C._before_mark(keyed, True)):      # later hours land first
        land.land_hours(part, path)
        stream.start_dedupe(stream.stream_staging(spark, path), sink, late, ckpt, delay="1 hour").awaitTermination()
    kept, behind = spark.read.parquet(sink), spark.read.parquet(late)
    uuids = parse_events(raw).select("uuid").distinct().count()
    assert behind.count() > 0 and kept.count() + behind.count() == uuids
    assert kept.select("uuid").unionByName(behind.select("uuid")).distinct().count() == uuids


def test_native_dedupe_within_the_watermark(spark, raw, tmp_path_spark):
    path = tmp_path_spark("nd-src")
    land.land_hours(land.with_hour_key(raw).where("hour_key is not null"), path)
    sink, ckpt = tmp_path_spark("nd"), tmp_path_spark("nd-ckpt")
    q = (stream.dedupe_stream(stream.stream_staging(spark, path), "60 days").writeStream.format("parquet")
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start(sink))
    q.awaitTermination()
    out = spark.read.parquet(sink)
    assert out.count() == out.select("uuid").distinct().count() > 0


def test_stream_upserts_equal_batch_in_any_order_and_twice(spark, raw, w, tmp_path_spark):
    stg_all, users = staged(raw), w.users()
    keyed = land.with_hour_key(raw)
    out_e, out_s = tmp_path_spark("se"), tmp_path_spark("ss")
    for i, part in enumerate((C._before_mark(keyed, False), C._before_mark(keyed, True))):
        path = tmp_path_spark(f"su-src-{i}")              # a source and a checkpoint of its own for each stream
        land.land_hours(part, path)
        src = lambda: stream.stream_staging(spark, path, max_files_per_trigger=12)
        stream.start_events_upsert(src(), out_e, tmp_path_spark("e-ck"), users).awaitTermination()
        stream.start_sessions_upsert(src(), out_s, ck := tmp_path_spark("s-ck")).awaitTermination()
    assert same(spark.read.parquet(out_e).drop("event_date"), facts.events(stg_all, users))
    assert same(spark.read.parquet(out_s).drop("session_date"), facts.sessions(stg_all))
    # the first batch once more, as a replay after a crash: nothing is counted twice
    rows, tag = spark.read.parquet(f"{out_s}_rows"), stream.stream._tag(ck, 0)
    before = rows.count()
    own = rows.where(F.col("batch") == tag).drop("batch")
    again = spark.createDataFrame(own.collect(), own.schema)
    assert again.count() > 0
    stream.stream._append(again, f"{out_s}_rows", tag, "event_date")
    assert spark.read.parquet(f"{out_s}_rows").count() == before


def test_register_views(spark, w):
    dag.register_views({"stg_events": w.stg}, prefix="t_")
    assert spark.sql("select count(distinct uuid) n from t_stg_events").first().n == 1000


def test_multi_source_landing_ledger(spark, raw, tmp_path_spark):
    path = tmp_path_spark("land-src")
    eid = F.try_variant_get("json_data", "$.event_id", "bigint")
    a = land.with_hour_key(raw.where(eid % 7 == 0), source="feed_a")
    b = land.with_hour_key(raw.where(eid % 21 == 0), source="feed_b")
    land.land_hours(a.unionByName(b), path)
    hours = land.landed_hours(spark, path)
    assert set(hours.columns) == {"source", "hour_key", "hour"}
    want = {(r.source, r.hour_key) for r in a.unionByName(b).select("source", "hour_key").distinct().collect() if r.hour_key}
    assert {(r.source, r.hour_key) for r in hours.collect()} == want
    # offering both feeds again lands nothing new
    assert land.land_new_hours(spark, a.unionByName(b), path) == []

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import oracle, rows_of
from eventloom.operators import facts
from eventloom.operators import incremental as inc
from eventloom.plans import catalog as C


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def stg(w):
    return w.stg


@pytest.fixture(scope="module")
def timed(stg):
    return stg.where("event_time is not null")


def test_session_merge_modes_sf0001(timed):
    mark = F.lit(C.SEED_MARK).cast("timestamp_ntz")
    seed = facts.sessions(timed.where(F.col("event_time") <= mark))
    new_rows = inc.since_high_water_mark(timed, seed, target_ts="session_end")
    whole = facts.sessions(timed).checkpoint()
    merged = inc.upsert_frames(seed, inc.merge_sessions(seed, new_rows), "session_id")
    assert same(merged, whole)
    over = inc.upsert_frames(seed, inc.merge_sessions(seed, new_rows, "overwrite"), "session_id")
    # only the sessions that lie across the mark lose their earlier events
    across = whole.where((F.col("session_start") <= mark) & (F.col("session_end") > mark)).count()
    assert across > 0 and over.exceptAll(whole).count() == across


def test_high_water_mark_semantics(spark, stg):
    empty = stg.limit(0)
    assert inc.since_high_water_mark(stg, None).count() == stg.count()
    assert inc.since_high_water_mark(stg, empty, empty="none").count() == 0
    assert inc.since_high_water_mark(stg, empty).count() == stg.count()
    target = stg.where(F.col("event_time") <= F.lit(C.SEED_MARK).cast("timestamp_ntz"))
    untimed = stg.where("event_time is null").count()
    with_them, without = (inc.since_high_water_mark(stg, target, untimed=u).count() for u in (True, False))
    assert untimed > 0 and with_them == without + untimed
    hwm = inc.high_water_mark(target, "event_time")
    late = spark.createDataFrame([(hwm - dt.timedelta(minutes=5),)], "event_time timestamp_ntz")
    assert inc.since_high_water_mark(late, target).count() == 0          # dropped for good
    assert inc.since_high_water_mark(late, target, lookback=dt.timedelta(hours=1)).count() == 1


@pytest.mark.parametrize("name", [
    "events_incremental", "events_lookback", "events_upsert_null_time", "sessions_incremental_overwrite",
    "sessions_merge_null_user", "sessions_incremental_table", "sessions_lookback", "schema_sync"])
def test_loads_equal_their_oracle(w, name):
    assert rows_of(C.STEPS[name](w)) == rows_of(oracle(name))


def test_partitioned_upsert_moves_keys(spark, tmp_path_spark):
    path = tmp_path_spark("upsert")
    t1 = spark.createDataFrame([("a", 1, "d1"), ("b", 2, "d1"), ("c", 3, "d2")], "k string, v int, p string")
    inc.upsert(spark, path, t1, "k", "p")
    # 'c' moves from d2 to d3 (d2 becomes empty), 'a' changes in place, 'z' is new
    t2 = spark.createDataFrame([("a", 10, "d1"), ("c", 30, "d3"), ("z", 9, "d3")], "k string, v int, p string")
    rep = inc.upsert(spark, path, t2, "k", "p")
    assert rep["touched"] == ["d1", "d2", "d3"]
    got = sorted((r.k, r.v, r.p) for r in spark.read.parquet(path).collect())
    assert got == [("a", 10, "d1"), ("b", 2, "d1"), ("c", 30, "d3"), ("z", 9, "d3")]
    # unpartitioned
    p2 = tmp_path_spark("upsert-flat")
    inc.upsert(spark, p2, t1.drop("p"), "k")
    inc.upsert(spark, p2, t2.drop("p"), "k")
    assert sorted((r.k, r.v) for r in spark.read.parquet(p2).collect()) == [("a", 10), ("b", 2), ("c", 30), ("z", 9)]


def test_null_partitions_and_null_keys_lose_nothing(spark, tmp_path_spark):
    path = tmp_path_spark("upsert-null")
    schema = "k string, v int, p date"
    d = dt.date(2024, 1, 1)
    inc.upsert(spark, path, spark.createDataFrame([("a", 1, None), ("b", 2, None), (None, 3, d)], schema), "k", "p")
    rep = inc.upsert(spark, path, spark.createDataFrame([("c", 4, None), (None, 5, d)], schema), "k", "p")
    assert rep["touched"] == [None, d]
    got = sorted(map(tuple, spark.read.parquet(path).select("k", "v", "p").collect()), key=str)
    assert got == sorted([("a", 1, None), ("b", 2, None), ("c", 4, None), (None, 5, d)], key=str)
    # the last rows of the NULL partition move away: the partition goes
    moved = spark.createDataFrame([("a", 1, d), ("b", 2, d), ("c", 4, d)], schema)
    inc.upsert(spark, path, moved, "k", "p")
    assert spark.read.parquet(path).where("p is null").count() == 0 and spark.read.parquet(path).count() == 4


def test_untouched_partitions_keep_their_files(spark, tmp_path_spark):
    path = tmp_path_spark("upsert-files")
    t = spark.createDataFrame([("a", 1, "x1"), ("b", 2, "x2")], "k string, v int, p string")
    inc.upsert(spark, path, t, "k", "p")
    files = lambda p: {f for f in spark.read.parquet(path).inputFiles() if f"p={p}/" in f}
    one, two = files("x1"), files("x2")
    inc.upsert(spark, path, spark.createDataFrame([("b", 3, "x2")], t.schema), "k", "p")
    assert files("x1") == one and files("x2") != two
    # a bound on where earlier rows may lie leaves a copy outside it alone
    inc.upsert(spark, path, spark.createDataFrame([("a", 9, "x2")], t.schema), "k", "p", keys_within=F.col("p") == "x2")
    assert files("x1") == one and spark.read.parquet(path).where("k = 'a'").count() == 2


def test_a_broken_swap_is_undone(spark, tmp_path_spark):
    path = tmp_path_spark("swap")
    inc.replace_table(spark.createDataFrame([(1,)], "k int"), path)
    inc._rename(spark, path, inc._old(path))              # as if the job died between its renames
    assert [r.k for r in inc.read_table(spark, path).collect()] == [1]
    inc.replace_table(spark.read.parquet(path).selectExpr("k + 1 as k"), path)
    assert [r.k for r in inc.read_table(spark, path).collect()] == [2] and not inc._exists(spark, inc._old(path))


def test_untimed_sessions_keep_their_attributes(spark):
    rows = [(1, 7, "u", "d", None, None, None, None, i, i, "/p") for i in (2, 1, 9000)]
    df = spark.createDataFrame(rows, "session_id_raw long, amplitude_id long, user_id string, device_id string, city string, "
                                     "region string, country string, event_time timestamp_ntz, eid long, tb long, page string")
    for split in ("minute", "hour", None):
        (r,) = facts.sessions_from_rows(df, split_by=split).collect()
        assert (r.user_id, r.device_id, r.event_count, r.user_journey) == ("u", "d", 3, "/p > /p > /p")


def test_sync_schema_modes(spark):
    t = spark.createDataFrame([(1, "x")], "id int, old string")
    i = spark.createDataFrame([(2, 5)], "id long, new int")
    a, b = inc.sync_schema(t, i, "sync_all_columns")
    assert a.columns == b.columns == ["id", "new"] and dict(a.dtypes)["id"] == "bigint"
    a, b = inc.sync_schema(t, i, "append_new_columns")
    assert a.columns == b.columns == ["id", "old", "new"]
    a, b = inc.sync_schema(t, i, "ignore")
    assert a.columns == b.columns == ["id", "old"]
    with pytest.raises(ValueError):
        inc.sync_schema(t, i, "fail")


@pytest.mark.parametrize("marks", [("2024-01-08 00:00:00", "2024-01-20 12:30:00"),
                                   ("2024-01-02 05:59:59", "2024-01-29 23:00:00")])
def test_sessions_in_slices_equal_one_shot(timed, marks):
    stg = timed
    ts = lambda m: F.lit(m).cast("timestamp_ntz")
    first = stg.where(F.col("event_time") <= ts(marks[0]))
    table = facts.sessions(first).checkpoint()
    for lo, hi in ((marks[0], marks[1]), (marks[1], None)):
        part = stg.where(F.col("event_time") > ts(lo))
        if hi:
            part = part.where(F.col("event_time") <= ts(hi))
        new_rows = inc.since_high_water_mark(part, table, target_ts="session_end")
        table = inc.upsert_frames(table, inc.merge_sessions(table, new_rows), "session_id").checkpoint()
    assert same(table, facts.sessions(stg))


def test_fact_invariants(w, stg):
    ev, se = C.q_events(w), C.q_sessions(w)
    assert ev.count() == stg.select("uuid").distinct().count()
    assert (se.agg(F.sum("event_count")).first()[0]
            == stg.where(F.col("session_id_raw").isNotNull()).count())
    for df, k in ((ev, "event_id"), (se, "session_id")):
        assert df.groupBy(k).count().where("count > 1").count() == 0

"""What a stream of upserts leaves on disk follows the table, not the batches."""

import random

from pyspark.sql import functions as F

from eventloom.operators import facts
from eventloom.operators import keyed_table as kt
from eventloom.operators.staging import parse_events, with_property_keys
from eventloom.plans import catalog
from eventloom.session import SHUFFLES_DROPPED, shuffles_dropped
from eventloom.sources import landing as land
from eventloom.sources.raw import read_raw
from eventloom.streaming import keyed, stream
from tests.test_keyed_table import content, day, rows, table


def files(spark, path):
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path")


def test_pieces_of_a_large_landing_hold_few_hours_each(spark, tmp_path_spark):
    """With fewer shuffle partitions than hours, partitions beyond the advisory size are cut by map
    tasks; each hour has the files that its own bytes need, not one for each piece."""
    hours, path = 120, tmp_path_spark("land-pieces")
    lines = spark.range(0, 24_000, 1, 8).select(
        F.concat(F.sha2(F.col("id").cast("string"), 512), F.sha2((-F.col("id")).cast("string"), 512)).alias("value"),
        F.concat(F.lit("2024-01-0"), F.floor(F.col("id") % hours / 24) + 1, F.lit("_"), F.lpad((F.col("id") % 24).cast("string"), 2, "0")).alias(land.HOUR_KEY))
    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")
    before = {k: spark.conf.get(k) for k in names}
    for k, v in zip(names, ("64k", "4")):
        spark.conf.set(k, v)
    try:
        land.land_hours(lines, path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    found = files(spark, path).where("path like '%hour_key=2024%'")
    assert hours <= found.count() <= 2 * hours
    assert spark.read.text(path).select("value").exceptAll(lines.select("value")).count() == 0
    assert spark.read.text(path).count() == 24_000


def test_compressed_landings_are_read_back(spark, raw_from_json, tmp_path_spark):
    path = tmp_path_spark("land-gzip")
    keyed = land.with_hour_key(raw_from_json(['{"uuid": "a", "event_time": "2024-01-01 03:00:00"}', '{"uuid": "b"}']))
    for _ in range(2):
        land.land_hours(keyed, path, compression="gzip")
    assert files(spark, path).where("path not like '%.txt.gz'").count() == 0
    assert sorted(r.uuid for r in parse_events(read_raw(spark, path)).collect()) == ["a", "b"]


def test_events_stream_keeps_the_newest_version_and_the_one_before(spark, raw_from_json, tmp_path_spark):
    """Each batch touches the whole table; versions do not add up, and no row is lost or repeated."""
    line = lambda u, t, c: f'{{"uuid": "{u}", "event_id": {c}, "amplitude_id": 1, "event_time": "2024-01-01 0{t}:00:00"}}'
    lines = [line(f"u{i}", t, 10 * t + i) for t in range(6) for i in (0, t + 1)]
    raw, src, out = raw_from_json(lines), tmp_path_spark("src"), tmp_path_spark("out")
    users = spark.createDataFrame([(1, "acme.com")], "amplitude_id bigint, company string")
    stray = f"{out}/data/load=running"
    for t in range(6):
        land.land_hours(land.with_hour_key(raw_from_json(lines[2 * t:2 * t + 2])), src)
        keyed.start_events(stream.stream_staging(spark, src), out, f"{out}-ckpt", users).awaitTermination()
        if t == 2:
            spark.range(1).write.parquet(stray)
    t = keyed.events_table(spark, out)
    assert t.manifest().version == 6 and t._versions() == [5, 6]
    loads = {r.path.split("load=")[1].split("/")[0] for r in files(spark, f"{out}/data").collect()}
    assert loads == {e.load for v in (5, 6) for e in t.manifest(v).entries} | {"running"}
    want = facts.events(with_property_keys(parse_events(raw)), users)
    got = t.read().drop("event_date")
    assert got.count() == 7 and got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_upserts_by_groups_of_partitions_equal_a_dictionary(spark, tmp_path_spark, monkeypatch):
    """Keys move between groups, NULL keys and NULL partitions included; an order keeps the later row."""
    monkeypatch.setattr(kt, "ROWS_PER_CORE", 2)
    seen = []
    monkeypatch.setattr(kt.KeyedTable, "_groups", lambda self, *a, real=kt.KeyedTable._groups: seen.append(real(self, *a)) or seen[-1])
    for order in (None, "v"):
        t, rng, want = table(spark, tmp_path_spark("keyed-groups")), random.Random(3), {}
        for step in range(3):
            keys = rng.sample([None, *map(str, range(60))], 40)
            load = [(k, rng.randrange(1000) * 1000 + step * 100 + i, rng.choice([None, 0, 1, 2, 3, 4])) for i, k in enumerate(keys)]
            report = t.upsert(rows(spark, load), order_by=order)
            want |= {k: (k, v, day(p)) for k, v, p in load if order is None or k not in want or v > want[k][1]}
            assert content(t) == sorted(want.values(), key=str)
            assert step == 0 or len(report["touched"]) == 6
    assert seen and all(len(g) > 1 for g in seen)


def test_a_querys_own_workspace_drops_what_it_has_read(spark):
    own, shared = (catalog.Workspace(spark, "/root/testdata/sf0.001", shared=s) for s in (False, True))
    for w in (own, shared):
        w.written("few", lambda: spark.range(3))
        path = w._paths["few"]
        w.release("few")
        assert catalog.inc._exists(spark, path) == w.shared
        assert w.written("few", lambda: spark.range(3)).count() == 3


def test_shuffles_are_dropped_only_within(spark):
    before = spark.conf.get(SHUFFLES_DROPPED)
    with shuffles_dropped(spark):
        assert spark.conf.get(SHUFFLES_DROPPED) == "true"
        assert spark.range(100).groupBy((F.col("id") % 7).alias("k")).count().count() == 7
    assert spark.conf.get(SHUFFLES_DROPPED) == before

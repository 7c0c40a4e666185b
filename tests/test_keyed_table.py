"""Versioned tables: whole loads, key filters, compaction."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from eventloom.operators import incremental as inc
from eventloom.operators import keyed_table as kt

SCHEMA = "k string, v int, p date"


def day(n):
    return None if n is None else dt.date(2024, 1, 1) + dt.timedelta(days=n)


def rows(spark, items):
    return spark.createDataFrame([(k, v, day(p)) for k, v, p in items], SCHEMA)


def content(table, version=None):
    return sorted((tuple(r) for r in table.read(version).collect()), key=str)


def table(spark, path):
    return kt.KeyedTable(spark, path, "k", "p")


def test_upserts_equal_a_dictionary(spark, tmp_path_spark):
    """Keys move between partitions, NULL keys and NULL partitions included."""
    t, rng, want = table(spark, tmp_path_spark("keyed")), random.Random(1), {}
    for step in range(4):
        keys = rng.sample([None, *map(str, range(60))], 25)
        load = [(k, step * 100 + i, rng.choice([None, 0, 1, 2, 3])) for i, k in enumerate(keys)]
        t.upsert(rows(spark, load))
        want |= {k: (k, v, day(p)) for k, v, p in load}
        assert content(t) == sorted(want.values(), key=str)
    assert content(t, 1) != content(t)


def test_only_candidates_are_searched_and_touched_partitions_rewritten(spark, tmp_path_spark):
    t = table(spark, tmp_path_spark("keyed-search"))
    t.upsert(rows(spark, [(f"{p}-{i}", i, p) for p in range(30) for i in range(40)]))
    before = {e.part: e.load for e in t.manifest().entries}
    report = t.upsert(rows(spark, [("3-1", 7, 3), ("5-2", 8, 9), ("new", 9, 20)]))
    assert report["touched"] == [str(day(p)) for p in (3, 5, 9, 20)]
    assert set(report["searched"]) >= {str(day(3)), str(day(5))} and len(report["searched"]) <= 4
    after = {e.part: e.load for e in t.manifest().entries}
    assert {p for p in after if after[p] == before[p]} == set(before) - set(report["touched"])
    read = t._rows(t.manifest(), t.candidates(rows(spark, [("7-7", 0, 0)]))).inputFiles()
    assert 1 <= len({f.split("p=")[1].split("/")[0] for f in read}) <= 2
    got = {r.k: (r.v, r.p) for r in t.lookup(rows(spark, [("5-2", 0, 0), ("7-7", 0, 0), ("none", 0, 0)])).collect()}
    assert got == {"5-2": (8, day(9)), "7-7": (7, day(7))}


def test_filters_have_every_key_and_few_others(spark, tmp_path_spark):
    t = table(spark, tmp_path_spark("keyed-filter"))
    n = 20_000
    held = spark.range(n).select(F.concat(F.lit("k"), "id").alias("k"), F.lit(1).alias("v"), F.lit("2024-01-01").cast("date").alias("p"))
    t.append(held)
    m = t.manifest()
    assert m.entries[0].rows == n
    probe = lambda lo, hi: spark.range(lo, hi).select(F.concat(F.lit("k"), "id").alias("k"))
    assert all(t.candidates(probe(i, i + 1), m) for i in range(0, n, n // 8))
    wrong = sum(bool(t.candidates(probe(n + i, n + i + 1), m)) for i in range(12))
    assert wrong <= 1


@pytest.mark.parametrize("step", ["data", "filters", "draft", "rename"])
def test_a_load_that_dies_leaves_the_old_table(spark, tmp_path_spark, monkeypatch, step):
    t = table(spark, tmp_path_spark(f"keyed-die-{step}"))
    t.upsert(rows(spark, [("a", 1, 0), ("b", 2, 1)]))
    old, increment = content(t), rows(spark, [("a", 9, 1), ("c", 3, 2)])

    class Died(Exception):
        pass

    def die(*_):
        raise Died

    with monkeypatch.context() as patch:
        if step == "data":            # rows written, no filters
            patch.setattr(kt, "_exists", die)
        elif step == "filters":       # rows and filters written, no manifest
            patch.setattr(t, "_commit", die)
        elif step == "draft":         # the manifest's text cannot be made
            patch.setattr(kt.Manifest, "dumps", die)
        else:                         # a draft lies there, unnamed
            fs = kt._fs

            class NoRename:
                def __init__(self, inner):
                    self.inner = inner

                def __getattr__(self, name):
                    return die if name == "rename" else getattr(self.inner, name)

            patch.setattr(kt, "_fs", lambda spark, path: (fs(spark, path)[0], NoRename(fs(spark, path)[1])))
        with pytest.raises(Died):
            t.upsert(increment)
    assert content(t) == old == content(table(spark, t.path))
    t.upsert(increment)
    assert content(t) == sorted([("a", 9, day(1)), ("b", 2, day(1)), ("c", 3, day(2))], key=str)
    t.vacuum(keep=1)
    assert content(t) == sorted([("a", 9, day(1)), ("b", 2, day(1)), ("c", 3, day(2))], key=str)
    folder, files = inc._fs(spark, f"{t.path}/data")
    names = {f.getPath().getName() for f in files.listStatus(folder)}
    assert {n for n in names if n.startswith("load=")} == {f"load={e.load}" for e in t.manifest().entries}


def test_two_loads_cannot_write_one_version(spark, tmp_path_spark):
    t = table(spark, tmp_path_spark("keyed-race"))
    t.append(rows(spark, [("a", 1, 0)]))
    stale = t.manifest()
    t.append(rows(spark, [("b", 2, 0)]))
    with pytest.raises(RuntimeError):
        t._commit(stale, rows(spark, []).schema, [])
    assert len(content(t)) == 2


def test_tagged_batches_count_once_and_compaction_keeps_rows(spark, tmp_path_spark):
    t = table(spark, tmp_path_spark("keyed-tags"))
    for tag in ("b1", "b2", "b1", "b3", "b2"):
        t.append(rows(spark, [(tag, 1, 0), (tag, 2, None)]), tag)
    assert len(content(t)) == 6 and len(t.manifest().entries) == 6
    assert {r.k for r in t.lookup(rows(spark, [("b1", 0, 0), ("b2", 0, 0)]), without_tag="b2").collect()} == {"b1"}
    before = content(t)
    assert t.compact(max_loads=2, keep={"b2", "b3"}) == 0
    assert t.compact(max_loads=2) == 2 and len(t.manifest().entries) == 2 and content(t) == before
    assert t.compact(max_loads=2) == 0
    t.append(rows(spark, []))
    assert content(t) == before
    t.replace(t.read().withColumn("w", F.lit("x")))
    assert [r.w for r in t.read().collect()] == ["x"] * 6


def test_cost_of_a_load_does_not_follow_the_age_of_the_table(spark, tmp_path_spark):
    """Twenty daily loads, each with a key of the day before: however many days there are, the
    day before and the load's own are searched and rewritten."""
    t = table(spark, tmp_path_spark("keyed-age"))
    t.upsert(rows(spark, [(f"-1-{i}", i, 0) for i in range(50)]))
    for n in range(20):
        report = t.upsert(rows(spark, [(f"{n}-{i}", i, n + 1) for i in range(50)] + [(f"{n - 1}-7", 99, n)]))
        assert report["touched"] == [str(day(n)), str(day(n + 1))] and len(report["searched"]) <= 2
    assert len(content(t)) == 21 * 50 and sum(v == 99 for _, v, _ in content(t)) == 20

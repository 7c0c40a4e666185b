"""Checks kept as counts beside each load."""

import pytest
from pyspark.sql import functions as F

from conftest import oracle, rows_of
from eventloom.operators import check_state, quality
from eventloom.operators.keyed_table import KeyedTable
from eventloom.plans import catalog as C

CHECKS = [quality.Check("t", "k", "unique"), quality.Check("t", "k", "not_null"), quality.Check("t", "v", "not_null"),
          quality.Check("t", "v", "relationships", "u", "v"), quality.Check("u", "v", "unique")]


def test_counts_follow_the_loads(spark, tmp_path_spark):
    t = KeyedTable(spark, tmp_path_spark("checked"), "k", "p")
    frame = lambda rows: spark.createDataFrame(rows, "k string, v string, p string")
    parent = spark.createDataFrame([("a",), ("b",), ("b",)], "v string")
    t.append(frame([("1", "a", "x"), ("2", None, "x"), ("3", "c", "y"), (None, "a", None)]))
    with pytest.raises(ValueError):
        check_state.state(t)
    assert check_state.update(t, "t", CHECKS) == 1 and check_state.update(t, "t", CHECKS) == 0
    for rows in ([("1", "b", "y"), ("4", "d", "z")], [("5", "c", "x"), ("5", "c", "z")], [("3", None, "x")]):
        if rows[0][0] == "3":
            t.upsert(frame(rows))          # rewrites x and y
        else:
            t.append(frame(rows))
        new = check_state.uncounted(t)
        files = t._rows(t.manifest(), new).inputFiles()
        assert len({e.load for e in new}) == 1 and all(f"load={new[0].load}" in f for f in files)
        assert check_state.update(t, "t", CHECKS) == 1
        whole = quality.run_suite({"t": t.read(), "u": parent}, CHECKS)
        kept = check_state.run_suite({"t": t}, {"u": parent}, CHECKS)
        assert sorted(map(str, kept.collect())) == sorted(map(str, whole.collect()))


def test_a_table_is_a_parent_by_its_counts(spark, tmp_path_spark):
    t = KeyedTable(spark, tmp_path_spark("checked-parent"), "v", "p")
    t.append(spark.createDataFrame([("a", "x"), ("b", "y")], "v string, p string"))
    check_state.update(t, "u", CHECKS)
    child = spark.createDataFrame([("1", "a"), ("2", "z"), ("3", None)], "k string, v string")
    got = {(r.model, r.column, r.check): r.failures for r in check_state.run_suite({"u": t}, {"t": child}, CHECKS).collect()}
    assert got["t", "v", "relationships"] == 1 and got["u", "v", "unique"] == 0 and got["t", "v", "not_null"] == 1


@pytest.mark.parametrize("name", ["dq_suite_incremental", "published_views", "run_layer", "run_full_refresh", "described_columns",
                                  "run_from_stored_parents", "events_moved_keys", "events_table_version"])
def test_queries_equal_their_oracle(w, name):
    assert rows_of(C.STEPS[name](w)) == rows_of(oracle(name))

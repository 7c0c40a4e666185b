"""Keys of stored tables meet by a shuffle, whatever their files' size: broadcast, they fill the driver."""

from pyspark.sql import functions as F

from eventloom.operators.incremental import matching
from eventloom.operators.keyed_table import KeyedTable


def test_keys_are_never_broadcast(spark, tmp_path_spark):
    table = KeyedTable(spark, tmp_path_spark("key-joins"), ["a", "b"], "day")
    # NULL keys match, and a partition without a value holds some
    rows = spark.range(60).select(F.when(F.col("id") % 20 != 3, F.col("id")).alias("a"), (F.col("id") % 4).alias("b"),
                                  F.when(F.col("id") % 3 != 0, F.expr("date'2024-01-01' + cast(id % 3 as int)")).alias("day"))
    m = table.append(rows)
    keys = rows.where("a is null or a < 10").select("a", "b")
    found = table.lookup(keys, m)
    for df in (table._hits(keys, list(m.entries)), found, matching(table.read(), keys, table.keys, "left_anti")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert sorted(map(str, found.collect())) == sorted(map(str, rows.where("a is null or a < 10").collect()))
    assert matching(table.read(), keys, table.keys, "left_anti").count() == 60 - found.count()

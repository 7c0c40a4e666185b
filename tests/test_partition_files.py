"""Files of partitioned tables: as many as the partitions need, not tasks times partitions."""

import glob

from pyspark.sql import functions as F

from eventloom.operators import incremental as inc

DAYS = 5


def _rows(spark, first, last):
    """Rows of all days in each of eight tasks; one day is NULL."""
    day = F.when(F.col("id") % DAYS != 0, F.col("id") % DAYS)
    return spark.range(first, last).repartition(8).withColumn("day", day).withColumn("v", F.lit(first))


def _files(path):
    return len(glob.glob(f"{path.removeprefix('file:')}/day=*/*.parquet"))


def test_tables_have_a_file_for_each_partition_whatever_task_held_its_rows(spark, tmp_path_spark):
    path = tmp_path_spark("replaced")
    inc.replace_table(_rows(spark, 0, 400), path, "day")
    assert spark.read.parquet(path).count() == 400 and _files(path) == DAYS


def test_upserts_keep_a_file_for_each_partition(spark, tmp_path_spark):
    path = tmp_path_spark("upserted")
    inc.upsert(spark, path, _rows(spark, 0, 400), "id", "day")
    assert _files(path) == DAYS
    inc.upsert(spark, path, _rows(spark, 300, 500), "id", "day")
    kept = spark.read.parquet(path).groupBy("v").count().collect()
    assert {r.v: r["count"] for r in kept} == {0: 300, 300: 200} and _files(path) <= 2 * DAYS

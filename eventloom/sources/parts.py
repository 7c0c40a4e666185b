"""Lines of groups cut into parts of bounded bytes, whatever a group's size.

An hour's file or archive must not grow with the hour.  Where a line lies in
its group is a prefix sum of bytes, made in two steps that spread over the
cluster: each task of the written input sums its own lines by group, a window
over these sums (one row for each group and task) says where each task's lines
begin, and a second one runs inside (group, task) only.  A line that begins in
the k-th stretch of a group goes to part k, so a third of all lines in one hour
become as many parts as their bytes need, each dealt on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.session import scratch_path

#: Bytes that a part may have, line ends included; one longer line is a part of its own.
PART_BYTES = 64 << 20


def with_parts(lines: DataFrame, group: str, value: str = "value", max_bytes: int = PART_BYTES) -> DataFrame:
    """``lines`` with ``part``, from 0 in each value of ``group``: no part has more than
    ``max_bytes`` bytes of ``value`` and line ends, unless it is a single line."""
    if max_bytes < 1:
        raise ValueError("max_bytes must be at least 1")
    spark, path = lines.sparkSession, scratch_path(lines.sparkSession, "parts")
    # Written once: the two passes below must see the same rows in the same tasks.
    (lines.withColumns({"__id": F.monotonically_increasing_id(), "__size": (F.octet_length(value) + 1).cast("long")})
     .write.parquet(path))
    rows = spark.read.parquet(path).withColumn("__task", F.shiftright("__id", 33))
    # Lines beyond a part's size count apart; the longest other one shortens the stretches,
    # so that the last line of a part fits too.
    long = F.col("__size") > max_bytes
    rows = rows.withColumns({"__long": long.cast("long"), "__size": F.when(long, 0).otherwise(F.col("__size"))})
    totals = rows.groupBy(group, "__task").agg(*[F.sum(c).alias(c) for c in ("__size", "__long")], F.max("__size").alias("__top"))
    tasks, whole = Window.partitionBy(group).orderBy("__task"), Window.partitionBy(group)
    begins = totals.select(
        F.col(group).alias("__group"), F.col("__task").alias("__of"),
        *[(F.sum(c).over(tasks) - F.col(c)).alias(f"{c}_before") for c in ("__size", "__long")], F.sum("__size").over(whole).alias("__sum"),
        F.least(F.lit(max_bytes), max_bytes - F.max("__top").over(whole) + 1).alias("__stretch"))
    own = Window.partitionBy(group, "__task").orderBy("__id")
    placed = (rows.withColumns({f"{c}_at": F.sum(c).over(own) - F.col(c) for c in ("__size", "__long")})
              .join(begins, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__task") == F.col("__of"))))
    stretch = F.col("__stretch")
    part = F.when(F.col("__long") == 0, F.floor((F.col("__size_before") + F.col("__size_at")) / stretch)).otherwise(
        F.ceil(F.col("__sum") / stretch) + F.col("__long_before") + F.col("__long_at"))
    return placed.withColumn("part", part.cast("long")).select(*lines.columns, "part")

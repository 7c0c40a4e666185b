"""Connected components of an edge table, by alternating stars.

Every round is two grouped minima and two joins over the edges that are left,
written to the shared folder; nothing but two checksums reaches the driver.
Grouped minima are combined before the shuffle and the joins have one row for
each key on one side, so a hub with very many edges is split by adaptive skew
handling.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import staged


def _star(edges: DataFrame) -> DataFrame:
    """Large star, then small star, over (u, v) with u > v."""
    ends = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = ends.groupBy("u").agg(F.min("v").alias("m")).select(
        F.col("u").alias("v"), F.least("u", "m").alias("m"))
    large = (edges.join(least, "v").select("u", F.col("m").alias("v"))
             .where("u > v").distinct())
    low = large.groupBy("u").agg(F.min("v").alias("m"))
    small = (large.join(low, "u").select(F.explode(F.array(
        F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
        F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*"))
    return small.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long) but the roots themselves;
    the root is the smallest node of the component.  Loops and repeats are ignored."""
    now = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .where("u > v").distinct(), "edges")
    sums = None
    while True:
        now_sums = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now_sums == sums or not now_sums[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        sums = now_sums
        now = staged(_star(now), "edges")

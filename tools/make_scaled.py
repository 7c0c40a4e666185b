"""Write a replicated (and optionally skewed) copy of the ``events`` table.

For scale runs of bench.py: ids and users are shifted per replica so keys
stay unique; with ``--skew`` one user receives a third of all rows (a hot
join/window key, hot IPs, long sessions).  Output goes to a fresh folder
under /tmp (never committed).

Usage: python tools/make_scaled.py SRC_DIR FACTOR [--skew]  -> prints the folder
"""

from __future__ import annotations

import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from eventloom.session import get_spark  # noqa: E402


def main() -> None:
    src, factor = sys.argv[1].rstrip("/"), int(sys.argv[2])
    skew = "--skew" in sys.argv
    out = tempfile.mkdtemp(prefix=f"eventloom-x{factor}{'-skew' if skew else ''}-")
    spark = get_spark("local[8]", shuffle_partitions=16)
    ev = spark.read.parquet(f"{src}/events.parquet")
    mx = ev.agg(F.max("event_id").alias("e"), F.max("user_id").alias("u")).first()
    rep = ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(factor - 1))).alias("k"))
    eid = F.col("event_id") + F.col("k") * F.lit(mx.e + 1)
    uid = F.col("user_id") + F.col("k") * F.lit(mx.u + 1)
    if skew:
        uid = F.when(F.pmod(F.xxhash64(eid), F.lit(3)) == 0, F.lit(1)).otherwise(uid)
    n = max(8, factor // 2)
    (rep.select(eid.alias("event_id"), "ts", uid.alias("user_id"), "event_type", "value", "props")
        .repartition(n).write.parquet(f"{out}/events.parquet"))
    print(out)


if __name__ == "__main__":
    main()

"""Files and archives of bounded bytes."""

import os

from pyspark.sql import functions as F

from eventloom.operators.staging import parse_events
from eventloom.sources import archives as arch
from eventloom.sources import landing as land
from eventloom.sources.parts import with_parts
from eventloom.sources.raw import raw_from_events, read_raw_with_hour
from conftest import SF001


def test_parts_are_bounded_and_lose_no_line(spark):
    """Half of the lines are in one group; one line is longer than a part."""
    lines = (spark.range(4000).select(F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 7)).alias("g"),
                                      F.repeat(F.lit("é"), (F.col("id") % 40).cast("int")).alias("value"), "id")
             .unionByName(spark.createDataFrame([("g1", "x" * 5000, -1), (None, "y", -2), ("hot", "", -3)], "g string, value string, id long"))
             .repartition(9))
    cut = with_parts(lines, "g", max_bytes=1000)
    assert cut.select("g", "value", "id").exceptAll(lines).count() == 0 and cut.count() == 4003
    parts = cut.groupBy("g", "part").agg(F.sum(F.octet_length("value") + 1).alias("bytes"), F.count("*").alias("n")).collect()
    assert all(r.bytes <= 1000 or r.n == 1 for r in parts) and {r.part for r in parts if r.g is None} == {0}
    hot = sorted(r.part for r in parts if r.g == "hot")
    total = cut.where("g = 'hot'").agg(F.sum(F.octet_length("value") + 1)).first()[0]
    assert hot[0] == 0 and total / 1000 <= len(hot) <= 1.2 * total / 920 + 1
    assert with_parts(lines.limit(0), "g").count() == 0


def test_flat_hours_and_archives_stay_below_the_bound(spark, tmp_path_spark):
    raw = raw_from_events(spark.read.parquet(f"{SF001}/events.parquet"))
    path = tmp_path_spark("flat-bounded")
    files = {r.file: r.lines for r in land.land_flat_hours(land.with_hour_key(raw), path, max_bytes=3000).collect()}
    base = path.removeprefix("file:")
    assert sum(files.values()) == raw.count() and any(n.endswith(".1.jsonl") for n in files)
    assert all(os.path.getsize(f"{base}/{n}") <= 3000 for n in files)
    back = parse_events(read_raw_with_hour(spark, path))
    assert back.count() == raw.count()
    assert back.where("event_time is not null and not (hour <=> date_trunc('hour', event_time))").count() == 0
    zips = tmp_path_spark("zips-bounded")
    written = arch.write_archives(raw, zips, max_bytes=3000).collect()
    assert sum(r.lines for r in written) == raw.count() and len(written) == len({r.archive for r in written})
    out = arch.unpack_archives(spark, zips)
    assert out.count() == raw.count() and parse_events(out.select("json_data")).select("uuid").distinct().count() == \
        parse_events(raw).select("uuid").distinct().count()
    members = arch.archive_members(spark, zips)
    assert members.count() == len(written) and members.agg(F.max("bytes")).first()[0] <= 3000

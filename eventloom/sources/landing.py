"""Hourly landing sinks and the present-hours ledger of a landed dataset.

* :func:`land_hours` writes raw events one folder per hour
  (``hour_key=YYYY-MM-DD_HH``) with dynamic partition overwrite: landing an
  hour again replaces it, so a refetch never duplicates lines.  Rows without
  an hour belong to no hour that could be fetched again; they lie in the NULL
  partition, to which only lines not yet in it are added.
* :func:`land_new_hours` publishes only hours absent from the target (an
  anti join on the hour ledger), leaving present hours untouched.
* :func:`landed_hours` reads the ledger of a landed dataset from its
  partition folders (no data files opened).
* :func:`land_flat_hours` writes one flat ``YYYY-MM-DD_HH.jsonl`` per hour.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.hours import format_hour, parse_hour
from eventloom.operators.incremental import _exists, matching
from eventloom.sources.files import write_named
from eventloom.sources.parts import PART_BYTES, with_parts

HOUR_KEY = "hour_key"
#: Partitions that the hours of a landing are dealt to.  One beyond the advisory size is split by map tasks, and each
#: piece writes a file for every hour of the partition: with few partitions, files number hours times pieces.  Above
#: 2,000 partitions Spark keeps a mean of their sizes only, and splits no hot hour.
HOUR_PARTITIONS = 1024


def with_hour_key(raw: DataFrame, source: str | None = None) -> DataFrame:
    ts = F.try_variant_get(F.col("json_data"), "$.event_time", "timestamp_ntz")
    out = raw.withColumn(HOUR_KEY, format_hour(ts))
    if source is not None:
        out = out.withColumn("source", F.lit(source))
    return out


def as_lines(raw_keyed: DataFrame) -> DataFrame:
    """Raw events as JSON text in place of the object: what landings write, rendered once for several of them."""
    return _lines(raw_keyed)[0]


def _lines(raw_keyed: DataFrame) -> tuple[DataFrame, list[str]]:
    parts = [c for c in ("source", HOUR_KEY) if c in raw_keyed.columns]
    if "json_data" not in raw_keyed.columns:
        return raw_keyed.select("value", *parts), parts
    return raw_keyed.select(F.to_json(F.col("json_data")).alias("value"), *parts), parts


def _add_untimed(lines: DataFrame, parts: list[str], path: str, compression: str | None) -> None:
    """Append the lines without an hour that the dataset does not hold yet."""
    new = lines.where(F.col(HOUR_KEY).isNull())
    if _exists(lines.sparkSession, path):
        landed = lines.sparkSession.read.text(path)
        if set(parts) <= set(landed.columns):
            held = landed.where(F.col(HOUR_KEY).isNull()).select("value", *[F.col(c).cast("string").alias(c) for c in parts])
            new = matching(new, held, ["value", *parts], "left_anti")
    new.write.mode("append").partitionBy(*parts).text(path, compression=compression)


def land_hours(raw_keyed: DataFrame, path: str, compression: str | None = None) -> None:
    """Write JSON lines partitioned by ``hour_key`` (and ``source`` if present).

    Each line is the raw object itself (or text that :func:`as_lines` made).  Rows are rebalanced by hour: small
    hours share tasks and give one file each, an hour beyond the advisory
    partition size (``spark.sql.adaptive.advisoryPartitionSizeInBytes``) is
    split over as many tasks as it needs.  ``compression`` is that of the files (``gzip``), by default none;
    readers tell it by the files' names.
    """
    lines, parts = _lines(raw_keyed)
    (lines.where(F.col(HOUR_KEY).isNotNull()).hint("rebalance", HOUR_PARTITIONS, *[F.col(c) for c in parts])
          .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
          .partitionBy(*parts).text(path, compression=compression))
    _add_untimed(lines, parts, path, compression)


def landed_hours(spark: SparkSession, path: str) -> DataFrame:
    """``(source?, hour_key, hour)`` present in a landed dataset.

    The ``binaryFile`` source lists one row per file and opens none unless
    its content is asked for; the keys are read off the paths.
    """
    if not _exists(spark, path):
        return spark.createDataFrame([], "hour_key string, hour timestamp_ntz")
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
             .select(F.regexp_extract("path", r"source=([^/]+)/", 1).alias("source"),
                     F.regexp_extract("path", r"hour_key=(\d[^/]+)/", 1).alias(HOUR_KEY)))
    keys = files.where(F.col(HOUR_KEY) != "").distinct()
    if not keys.where(F.col("source") != "").take(1):
        keys = keys.drop("source")
    return keys.withColumn("hour", parse_hour(F.col(HOUR_KEY)))


def land_new_hours(spark: SparkSession, raw_keyed: DataFrame, path: str) -> list[str]:
    """Land only the hours not yet present at ``path`` (and the lines without
    an hour that are not); return the keys of the hours.

    The hour list is read before writing (it is one value per landed hour,
    not per row), because afterwards the ledger already contains them.
    """
    present = landed_hours(spark, path)
    keys = [c for c in ("source", HOUR_KEY) if c in raw_keyed.columns and c in present.columns]
    untimed = F.col(HOUR_KEY).isNull()
    new = raw_keyed.where(untimed).unionByName(
        raw_keyed.where(~untimed).join(present.select(*keys), keys, "left_anti").select(*raw_keyed.columns))
    landed = sorted("/".join(str(v) for v in r) for r in new.where(~untimed).select(*keys).distinct().collect())
    land_hours(new, path)
    return landed


def land_flat_hours(raw_keyed: DataFrame, path: str, max_bytes: int = PART_BYTES) -> DataFrame:
    """Flat files ``<hour>.jsonl``, the layout of a downloaded export; lines without an
    hour go to ``untimed.jsonl``.  An hour of more than ``max_bytes`` goes on in
    ``<hour>.1.jsonl`` and so on, each file written by a task of its own.
    Returns ``(file, lines)``; the files are written when it is computed."""
    lines, _ = _lines(raw_keyed)
    cut = with_parts(lines.select(F.coalesce(F.col(HOUR_KEY), F.lit("untimed")).alias("name"), "value"), "name", max_bytes=max_bytes)
    number = F.when(F.col("part") == 0, "").otherwise(F.concat(F.lit("."), F.col("part")))
    return write_named(cut.select(F.concat("name", number, F.lit(".jsonl")).alias("file"), "value"), path)

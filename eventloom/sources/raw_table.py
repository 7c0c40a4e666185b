"""Raw events as a stored table of one VARIANT column, a folder per hour.

Spark shreds the objects of each Parquet file it writes into typed
sub-columns.  A lookup of one field with a fixed path then becomes part of the
scan: only that field's column chunks are read, and neither the JSON text nor
the whole object is put together again.  :func:`staging.parse_events` asks that
way with ``lookup="fields"``, so a model over the stored table reads the fields
it uses.  A field whose type differs between rows keeps the odd values beside
the typed ones; nothing is lost by shredding.

Landing follows :mod:`eventloom.sources.landing`: landing an hour again
replaces it, and of the rows without an hour only those are added that the
table does not hold yet (a malformed line, a NULL object, is one of these).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.hours import format_hour
from eventloom.operators.incremental import _exists, matching
from eventloom.sources.landing import HOUR_KEY
from eventloom.sources.raw import RAW_COL

SCHEMA = f"{RAW_COL} variant, {HOUR_KEY} string"


def land_raw_table(raw_keyed: DataFrame, path: str) -> None:
    """Write raw events (``json_data``, ``hour_key``) into the table at ``path``.

    Rows are rebalanced by hour: an hour beyond the advisory partition size is
    written by as many tasks, into as many files, as it needs.
    """
    rows = raw_keyed.select(RAW_COL, HOUR_KEY)
    spark = rows.sparkSession
    held = read_raw_table(spark, path).where(F.col(HOUR_KEY).isNull()) if _exists(spark, path) else None
    (rows.where(F.col(HOUR_KEY).isNotNull()).hint("rebalance", HOUR_KEY)
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(HOUR_KEY).parquet(path))
    untimed = rows.where(F.col(HOUR_KEY).isNull())
    if held is not None:
        # VARIANT values cannot be compared, their text can
        text = lambda df: df.withColumn("__text", F.to_json(RAW_COL))
        untimed = matching(text(untimed), text(held).select("__text"), ["__text"], "left_anti").drop("__text")
    untimed.write.mode("append").partitionBy(HOUR_KEY).parquet(path)


def read_raw_table(spark: SparkSession, path: str, since: _dt.datetime | None = None) -> DataFrame:
    """The table's rows, with ``hour_key``.  ``since`` leaves out the folders of
    hours before it; rows without an hour lie on neither side and always come."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    if since is None:
        return rows
    first = format_hour(F.lit(since).cast("timestamp_ntz"))
    return rows.where((F.col(HOUR_KEY) >= first) | F.col(HOUR_KEY).isNull())

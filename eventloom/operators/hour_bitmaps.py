"""The hour ledger as bitmaps: one bit for each hour, a row for each source and 32,768 hours.

A landing adds its hours to a stored ledger as bitmaps of its own
(``bitmap_construct_agg``), in one small file; a reader merges them
(``bitmap_or_agg``), so neither lists the landed files nor reads events again.
A landing that is repeated adds bits that are there already.

The audited range is a bitmap test per hour on the one row that a source and
bucket have left, and feeds the report, resume points and batches of
:mod:`eventloom.operators.coverage` as their ``present`` hours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.hours import hour_range, ntz_lit, trunc_hour
from eventloom.operators.coverage import HOUR, SRC
from eventloom.operators.incremental import read_table

LEDGER = f"{SRC} string, bucket bigint, bits binary"
#: Hours in a bitmap (fixed by Spark's bitmap functions).
BUCKET = 32_768
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def hour_number(hour: Column) -> Column:
    """Hours since 1970, without a time zone; from 1 on, as the functions count."""
    return F.timestamp_diff("HOUR", F.expr(_EPOCH), hour).cast("long") + 1


def hour_of(number: Column) -> Column:
    return F.timestamp_add("HOUR", number - 1, F.expr(_EPOCH))


def bitmaps(present: DataFrame) -> DataFrame:
    """(source, bucket, bits) of ``(source, hour)`` rows, repeated ones or not."""
    n = hour_number(F.col(HOUR))
    return (present.where(F.col(HOUR).isNotNull())
            .select(SRC, F.bitmap_bucket_number(n).alias("bucket"), F.bitmap_bit_position(n).alias("at"))
            .groupBy(SRC, "bucket").agg(F.bitmap_construct_agg("at").alias("bits")))


def record(present: DataFrame, path: str) -> None:
    """Add the hours of a landing to the ledger at ``path``."""
    bitmaps(present).coalesce(1).write.mode("append").parquet(path)  # at most a row for each source and bucket


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The merged ledger; empty where none is stored."""
    stored = read_table(spark, path)
    if stored is None:
        return spark.createDataFrame([], LEDGER)
    return stored.groupBy(SRC, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def has(bits: Column, at: Column) -> Column:
    """Whether bit ``at`` (from 0) is set."""
    byte = F.conv(F.hex(F.substring(bits, (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1, F.lit(False))


def hours(rows: DataFrame, start=None, end=None) -> DataFrame:
    """``(source, hour)`` rows of a ledger, those of ``[start, end]`` if given."""
    first = (F.col("bucket") - 1) * BUCKET + 1
    low = first if start is None else F.greatest(first, hour_number(trunc_hour(ntz_lit(start))))
    high = first + BUCKET - 1 if end is None else F.least(first + BUCKET - 1, hour_number(ntz_lit(end)))
    numbers = F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<bigint>"))
    set_ = F.filter(numbers, lambda n: has(F.col("bits"), n - first))
    return rows.select(SRC, F.explode(set_).alias("n")).select(SRC, hour_of(F.col("n")).alias(HOUR))


def counts(rows: DataFrame) -> DataFrame:
    """(source, n_hours): how many hours a source has, by counting bits."""
    return rows.groupBy(SRC).agg(F.sum(F.bitmap_count("bits")).cast("bigint").alias("n_hours"))


def missing(rows: DataFrame, start, end) -> DataFrame:
    """``(source, hour)`` of ``[start, end]`` without a bit, for every source of the ledger: the
    bitmaps of a source (few: one for each 32,768 hours) meet as one array."""
    buckets = rows.groupBy(SRC).agg(F.map_from_entries(F.collect_list(F.struct("bucket", "bits"))).alias("maps"))
    number = hour_number(F.col("h"))
    found = buckets.select(SRC, "maps", F.explode(hour_range(ntz_lit(start), ntz_lit(end))).alias("h"))
    held = has(F.element_at("maps", F.bitmap_bucket_number(number)), F.bitmap_bit_position(number))
    return found.where(~held).select(SRC, F.col("h").alias(HOUR))

"""Export archives: ZIP files whose members are gzip'd JSON lines.

Reading: ``binaryFile`` lists the archives without their content, a first step
reads each archive's directory, and the members, dealt anew, are streamed
through gzip from their own range of the archive, a batch of lines at a time.  So
an archive of any size spreads over as many tasks as it has members, and a task
holds one batch of lines.  Paths must be ones that Arrow can open (local or
mounted, ``hdfs://``, ``s3://``, ``gs://``).  The member name becomes the hour key
(same rules as :func:`hour_key_from_name`, applied natively after the Python
step).

Writing (used to produce archives from the driver tables): one archive holds one
part of one hour, of bounded bytes (:mod:`eventloom.sources.parts`), streamed by
:func:`eventloom.sources.files.write_named`.
"""

from __future__ import annotations

import gzip
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.hours import format_hour, hour_key_from_name, parse_hour
from eventloom.sources.files import open_folder, write_named
from eventloom.sources.parts import PART_BYTES, with_parts

UNPACK_SCHEMA = "archive string, member string, line string"
#: A batch of lines ends at this many lines or bytes.
BATCH_LINES, BATCH_BYTES = 10_000, 8 << 20
#: Compressed bytes of members that a task unpacks, about.
TASK_BYTES = 8 << 20


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members that each archive's directory names, with their bytes; nothing else is read."""
    for batch in batches:
        for path in batch.column("path").to_pylist():
            fs, name = open_folder(path)
            with fs.open_input_file(name) as f, zipfile.ZipFile(f) as z:
                found = [(i.filename, i.compress_size) for i in z.infolist() if i.filename.endswith(".json.gz")]
            if found:
                names, sizes = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(found)), pa.array(names), pa.array(sizes, pa.int64())],
                                                 names=["archive", "member", "bytes"])


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def batch_of(path: str, member: str, lines: list[str]) -> pa.RecordBatch:
        n = len(lines)
        return pa.RecordBatch.from_arrays([pa.array([path] * n), pa.array([member] * n), pa.array(lines)],
                                          names=["archive", "member", "line"])

    for batch in batches:
        for path, member in zip(batch.column("archive").to_pylist(), batch.column("member").to_pylist()):
            lines, size = [], 0
            fs, name = open_folder(path)
            # Only the directory and the member's own range are read.
            with fs.open_input_file(name) as f, zipfile.ZipFile(f) as z, z.open(member) as raw, gzip.GzipFile(fileobj=raw) as text:
                for line in text:
                    line = line.rstrip(b"\r\n")
                    if not line.strip():
                        continue
                    lines.append(line.decode("utf-8", "replace"))
                    size += len(line)
                    if len(lines) >= BATCH_LINES or size >= BATCH_BYTES:
                        yield batch_of(path, member, lines)
                        lines, size = [], 0
            if lines:
                yield batch_of(path, member, lines)


def archive_members(spark: SparkSession, path: str) -> DataFrame:
    """``(archive, member, bytes)`` of the archives under ``path``, from their directories."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.zip")
             .option("recursiveFileLookup", "true").load(path).select("path"))
    return files.mapInArrow(_members, "archive string, member string, bytes long")


def unpack_archives(spark: SparkSession, path: str) -> DataFrame:
    """Archives under ``path`` -> ``(archive, member, hour_key, hour, json_data)``.

    A line that is not valid JSON gives NULL ``json_data`` (like the JSON
    source), for the not_null check on the raw relation to report.
    """
    members = archive_members(spark, path)
    # A number of its own: by columns alone, adaptive execution would see only the members' names,
    # a few bytes each, and put them all into one task.
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")),
                -(-(members.agg(F.sum("bytes")).first()[0] or 0) // TASK_BYTES))
    dealt = members.repartition(tasks, "archive", "member").select("archive", "member")
    rows = dealt.mapInArrow(_unpack, UNPACK_SCHEMA)
    key = hour_key_from_name("member")
    return rows.select("archive", "member", key.alias("hour_key"), parse_hour(key).alias("hour"),
                       F.try_parse_json("line").alias("json_data"))


def write_archives(raw: DataFrame, out_dir: str, buckets: int | None = None, project: str = "100011471",
                   max_bytes: int = PART_BYTES) -> DataFrame:
    """Write raw events as ZIP archives into the shared folder ``out_dir``, each streamed by one
    task: an hour goes into as many as ``max_bytes`` of lines need, or into ``buckets``.
    Events without a time go to archives whose member has no hour.
    Returns ``(archive, lines)``; the archives are written when it is computed."""
    text = F.to_json(F.col("json_data"))
    ts = F.try_variant_get(F.col("json_data"), "$.event_time", "timestamp_ntz")
    lines = raw.select(text.alias("value"), F.coalesce(format_hour(ts), F.lit("untimed")).alias("key"))
    if buckets is None:
        lines = with_parts(lines.withColumn("value", F.coalesce("value", F.lit("null"))), "key", max_bytes=max_bytes)
    else:
        lines = lines.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(buckets)))
    part = F.col("part").cast("string")
    # unpadded hour and a '#' suffix, as export archives name members
    member = F.concat(F.lit(f"{project}/{project}_"), F.regexp_replace("key", "_0(\\d)$", "_$1"), F.lit("#"), part, F.lit(".json.gz"))
    return (write_named(lines.select(F.concat("key", F.lit("-"), part, F.lit(".zip")).alias("file"), "value", member.alias("member")), out_dir, zipped=True)
            .select(F.col("file").alias("archive"), "lines"))

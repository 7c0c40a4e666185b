"""Structured Streaming variants of the loads.

* :func:`stream_raw` — landed JSONL folders as a stream of VARIANT rows;
  the checkpoint's file log replaces a hand-kept ledger of loaded hours.
* :func:`start_dedupe` — exact uuid dedupe into a table (the *first* copy
  seen stays; the batch fact keeps the latest).  First copies that arrive
  after the watermark go to a side table of their own, so nothing is lost
  and what was late can be counted.
* :func:`start_events_upsert` / :func:`start_sessions_upsert` —
  ``foreachBatch`` sinks that give the batch model's answer whatever the
  order in which hours land and however files fall into micro-batches.

Sinks are idempotent by content, not by batch number: an upsert applied
twice changes nothing, and rows that are appended lie in a folder named after
the stream's checkpoint and the batch, which a replay overwrites.  So any
number of streams, with any checkpoints, may write to one table, one after
the other.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.hours import ntz_lit
from eventloom.operators import facts
from eventloom.operators import incremental as inc
from eventloom.operators.latest import latest_per_key
from eventloom.operators.staging import parse_events
from eventloom.session import scratch_path
from eventloom.sources.raw import RAW_COL

BATCH = "batch"


def stream_raw(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed JSONL (one folder per hour) as a stream of ``json_data VARIANT``
    rows: text lines parsed once with ``try_parse_json`` (malformed -> NULL)."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = r.load(path)
    return df.select(F.try_parse_json("value").alias(RAW_COL))


def stream_staging(spark: SparkSession, path: str, mode: str = "permissive", **kw) -> DataFrame:
    """Streaming staging; permissive by default so one bad record cannot
    stop a long-running query (use ``quarantine`` to keep the reasons)."""
    return parse_events(stream_raw(spark, path, **kw), mode=mode)


def dedupe_stream(stg: DataFrame, delay: str = "12 hours", key: str = "uuid") -> DataFrame:
    """Spark's own bounded-state dedupe: drop repeated ``key`` values seen
    within ``delay`` of event time.

    Rows behind the watermark are dropped whether they repeat a key or not
    (the progress metric ``numRowsDroppedByWatermark`` counts them); where
    that may not happen use :func:`start_dedupe`.
    """
    wm = F.col("event_time").cast("timestamp")
    return (stg.withColumn("__wm", wm).withWatermark("__wm", delay)
               .dropDuplicatesWithinWatermark([key]).drop("__wm"))


def _start(stream: DataFrame, apply, checkpoint: str, available_now: bool):
    w = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()


def _tag(checkpoint: str, batch_id: int) -> str:
    return f"{hashlib.md5(checkpoint.rstrip('/').encode()).hexdigest()[:12]}-{batch_id:09d}"


def _append(rows: DataFrame, path: str, tag: str, *parts: str) -> None:
    """Rows into the batch's own folders; a replayed batch overwrites them."""
    (rows.withColumn(BATCH, F.lit(tag)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH, *parts).parquet(path))


def _earlier(spark: SparkSession, path: str, tag: str) -> DataFrame | None:
    """What other batches than ``tag`` have stored."""
    table = inc.read_table(spark, path)
    return None if table is None else table.where(F.col(BATCH) != tag)


def start_dedupe(stg_stream: DataFrame, sink_path: str, late_path: str, checkpoint: str,
                 delay: str = "12 hours", key: str = "uuid", available_now: bool = True):
    """First copy of every ``key`` (NULL is one key) into the table at ``sink_path``;
    first copies older than the stored rows' latest time less ``delay`` into
    the one at ``late_path``.  Together they hold each key once.

    Each micro-batch looks its keys up in the key column of both tables, so
    no copy is let through for having been long ago.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark, tag = batch.sparkSession, _tag(checkpoint, batch_id)
        stored = [t for t in (_earlier(spark, p, tag) for p in (sink_path, late_path)) if t is not None]
        new = latest_per_key(batch, [key], "event_time", tiebreak=["event_id_raw"])
        for t in stored:
            new = inc.matching(new, t.select(key), [key], "left_anti")
        # staged once, as the two parts below must be parts of the same rows
        path = scratch_path(spark, "dedupe")
        new.write.mode("overwrite").parquet(path)
        new = spark.read.schema(new.schema).parquet(path)
        mark = stored[0].agg(F.max("event_time")).first()[0] if stored else None
        late = F.lit(False) if mark is None else F.coalesce(
            F.col("event_time") < ntz_lit(mark) - F.expr(f"INTERVAL {delay}"), F.lit(False))
        _append(new.where(~late), sink_path, tag)
        _append(new.where(late), late_path, tag)
        inc._delete(spark, path)

    return _start(stg_stream, apply, checkpoint, available_now)


def start_events_upsert(stg_stream: DataFrame, out_path: str, checkpoint: str, users: DataFrame,
                        available_now: bool = True):
    """Per micro-batch: build the event fact of the batch and upsert it on
    event_id into the table at ``out_path`` (partitioned by event date, NULL
    dates included).  Across batches the latest copy of a uuid wins, as in
    the batch model, so a batch applied twice or out of order does no harm."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        rows = facts.events(batch, users).withColumn("event_date", F.to_date("event_time"))
        inc.upsert(batch.sparkSession, out_path, rows, "event_id", "event_date", order_by="event_time")

    return _start(stg_stream, apply, checkpoint, available_now)


def start_sessions_upsert(stg_stream: DataFrame, out_path: str, checkpoint: str, available_now: bool = True):
    """Per micro-batch: keep the batch's narrow session rows in
    ``<out_path>_rows`` (by batch and event date), rebuild the sessions they
    touch from all rows kept, and upsert these into the table at
    ``out_path`` (partitioned by start date)."""
    rows_path = f"{out_path.rstrip('/')}_rows"

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark, tag = batch.sparkSession, _tag(checkpoint, batch_id)
        _append(facts.session_rows(batch).withColumn("event_date", F.to_date("event_time")), rows_path, tag, "event_date")
        rows = inc.read_table(spark, rows_path)
        if rows is None:
            return
        own = rows.where(F.col(BATCH) == tag)
        built = inc.rebuild_sessions(rows.drop(BATCH, "event_date"), own, inc.read_table(spark, out_path))
        inc.upsert(spark, out_path, built.withColumn("session_date", F.to_date("session_start")),
                   "session_id", "session_date")

    return _start(stg_stream, apply, checkpoint, available_now)


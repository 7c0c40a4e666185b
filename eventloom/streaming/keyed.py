"""Streaming loads into versioned tables (:mod:`eventloom.operators.keyed_table`).

Each micro-batch is one commit, found again by its tag (the stream's checkpoint
and the batch's number): a batch applied once more after a crash replaces what
it had stored.  Stored rows of a batch's keys are found by the tables' key
filters, so a batch reads the partitions that hold its keys, whatever the
tables' age, and answers are the batch models' in any order of landing.  Old
versions and the files only they name are dropped by ``KeyedTable.vacuum``, which
a job of its own calls from time to time.  The events stream drops them itself: each
of its batches may rewrite the whole table, so versions would add up to batches times table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.hours import ntz_lit
from eventloom.operators import facts
from eventloom.operators import incremental as inc
from eventloom.operators.facts import SESSION_KEYS
from eventloom.operators.keyed_table import KeyedTable
from eventloom.operators.latest import latest_per_key
from eventloom.session import scratch_path, shuffles_dropped
from eventloom.streaming.stream import _start, _tag

#: Loads of a partition from which its files are put together.
LOADS = 16


def events_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, "event_id", "event_date")


def sessions_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, "session_id", "session_date")


def session_rows_table(spark: SparkSession, path: str) -> KeyedTable:
    """The narrow rows that the sessions at ``path`` are built from."""
    return KeyedTable(spark, f"{path.rstrip('/')}_rows", SESSION_KEYS, "event_date")


def unique_table(spark: SparkSession, path: str, key: str = "uuid") -> KeyedTable:
    return KeyedTable(spark, path, key, "event_date")


def _tidy(table: KeyedTable) -> None:
    """Put small loads together, but for each stream's last batch, which may come again."""
    newest: dict[str, str] = {}
    for e in table.manifest().entries:
        if e.tag:
            stream = e.tag.rpartition("-")[0]
            newest[stream] = max(newest.get(stream, ""), e.tag)
    table.compact(LOADS, set(newest.values()))


def start_events(stg_stream: DataFrame, out_path: str, checkpoint: str, users: DataFrame, available_now: bool = True,
                 keep: int = 1):
    """Per micro-batch: the batch's event fact, upserted on event_id; the latest copy of a
    uuid wins across batches.  A batch begins by dropping all but the newest ``keep`` versions: the
    one that it replaces stays readable until the next batch."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        table = events_table(batch.sparkSession, out_path)
        table.vacuum(keep, strays=False)
        rows = facts.events(batch, users).withColumn("event_date", F.to_date("event_time"))
        with shuffles_dropped(batch.sparkSession):
            table.upsert(rows, order_by="event_time")

    return _start(stg_stream, apply, checkpoint, available_now)


def start_sessions(stg_stream: DataFrame, out_path: str, checkpoint: str, available_now: bool = True):
    """Per micro-batch: store the batch's narrow session rows, look up all rows of the sessions
    they belong to, and upsert these sessions."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark, tag = batch.sparkSession, _tag(checkpoint, batch_id)
        store = session_rows_table(spark, out_path)
        _tidy(store)
        m = store.append(facts.session_rows(batch).withColumn("event_date", F.to_date("event_time")), tag)
        own = [e for e in m.entries if e.tag == tag]
        if own:
            keys = store._rows(m, own).select(*SESSION_KEYS).distinct()
            built = facts.sessions_from_rows(store.lookup(keys, m).drop("event_date"))
            sessions_table(spark, out_path).upsert(built.withColumn("session_date", F.to_date("session_start")))

    return _start(stg_stream, apply, checkpoint, available_now)


def start_dedupe(stg_stream: DataFrame, out_path: str, checkpoint: str, delay: str = "12 hours", key: str = "uuid",
                 available_now: bool = True):
    """The first copy of every ``key`` (NULL is one key), with ``late``: whether it came behind
    the latest stored time less ``delay``.  On-time and late rows are one commit."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark, tag = batch.sparkSession, _tag(checkpoint, batch_id)
        table = unique_table(spark, out_path, key)
        _tidy(table)
        m = table.manifest()
        new = latest_per_key(batch, [key], "event_time", tiebreak=["event_id_raw"])
        late, path = F.lit(False), scratch_path(spark, "dedupe")
        if m.version:
            # Written once: the lookup passes over the keys twice, and each pass over the batch parses its lines again.
            new.write.parquet(path)
            new = spark.read.schema(new.schema).parquet(path)
            new = inc.matching(new, table.lookup(new.select(key), m, without_tag=tag), [key], "left_anti")
            dated = [e for e in m.entries if e.part is not None and e.tag != tag]
            if dated:
                last = max(e.part for e in dated)
                mark = table._rows(m, [e for e in dated if e.part == last]).agg(F.max("event_time")).first()[0]
                late = F.coalesce(F.col("event_time") < ntz_lit(mark) - F.expr(f"INTERVAL {delay}"), F.lit(False))
        table.append(new.withColumns({"late": late, "event_date": F.to_date("event_time")}), tag)
        inc._delete(spark, path)

    return _start(stg_stream, apply, checkpoint, available_now)

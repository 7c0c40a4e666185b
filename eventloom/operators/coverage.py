"""Hour-coverage ledger over ``(source, hour)`` relations.

The landing side decides which hours of which feed are missing, batches
consecutive missing hours into request ranges, finds where to resume, and
which landed hours still need publishing.  Here each of those is a
relational step over ``(source, hour timestamp_ntz)`` rows:

* sets of hours are DataFrames and set algebra is semi/anti joins on
  ``(source, hour)`` (shuffled by source and hour, no driver-side sets);
* :func:`ledger` holds, per source, the missing hours of the audited range
  as one array (at most one entry per hour of the range); report, resume
  points and batches all come from it, so the events are read once;
* islands of consecutive hours use a window partitioned by ``source``
  (never a global window); each partition holds at most one row per hour
  of the requested range, so no source can be skewed beyond that;
* batching with a cap explodes each island into its chunks, no second
  window needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.functions.hours import format_hour, hour_range, ntz_lit, trunc_hour

SRC, HOUR = "source", "hour"


def _lit_ts(v) -> Column:
    return ntz_lit(v)


def present_hours(df: DataFrame, source_col: str | Column, ts_col: str | Column) -> DataFrame:
    """Distinct ``(source, hour)`` that hold at least one row."""
    s = F.col(source_col) if isinstance(source_col, str) else source_col
    t = F.col(ts_col) if isinstance(ts_col, str) else ts_col
    return (df.select(s.cast("string").alias(SRC),
                      trunc_hour(t.cast("timestamp_ntz")).alias(HOUR))
              .where(F.col(HOUR).isNotNull())
              .distinct())


def required_hours(sources: DataFrame, start, end) -> DataFrame:
    """Every hour in ``[start, end]`` (inclusive) for every source.

    A generator per source row (``explode(sequence)``), not a join; the
    output is exactly the hour grid the ledger must cover.
    """
    return (sources.select(F.col(SRC).cast("string").alias(SRC)).distinct()
                   .select(SRC, F.explode(hour_range(_lit_ts(start), _lit_ts(end))).alias(HOUR)))


def _covered(present: DataFrame, known_empty: DataFrame | None) -> DataFrame:
    """Hours that need no fetch: present, or known to have had no events."""
    p = present.select(SRC, HOUR)
    return p if known_empty is None else p.unionByName(known_empty.select(SRC, HOUR))


def missing_hours(required: DataFrame, present: DataFrame,
                  known_empty: DataFrame | None = None) -> DataFrame:
    """Required hours neither present nor listed in ``known_empty`` (hours a
    source confirmed to have no events; without it such an hour never gets
    a file and stays missing forever)."""
    return required.join(_covered(present, known_empty), [SRC, HOUR], "left_anti")


def covered_hours(required: DataFrame, present: DataFrame) -> DataFrame:
    return required.join(present.select(SRC, HOUR), [SRC, HOUR], "left_semi")


def publishable(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Landed locally but not yet in the target: to upload."""
    return local.select(SRC, HOUR).join(remote.select(SRC, HOUR), [SRC, HOUR], "left_anti")


def discardable(local: DataFrame, remote: DataFrame) -> DataFrame:
    """Landed locally and already in the target: safe to drop locally."""
    return local.select(SRC, HOUR).join(remote.select(SRC, HOUR), [SRC, HOUR], "left_semi")


def islands(hours: DataFrame) -> DataFrame:
    """Maximal runs of consecutive hours per source -> (source, start, end, n)."""
    w = Window.partitionBy(SRC).orderBy(HOUR)
    seq_hours = F.make_dt_interval(F.lit(0), F.row_number().over(w).cast("int"))
    grp = (F.col(HOUR) - seq_hours).alias("__grp")
    return (hours.select(SRC, HOUR, grp)
                 .groupBy(SRC, "__grp")
                 .agg(F.min(HOUR).alias("batch_start"), F.max(HOUR).alias("batch_end"),
                      F.count(F.lit(1)).alias("n_hours"))
                 .drop("__grp"))


def batch_hours(missing: DataFrame, max_hours: int | None = None) -> DataFrame:
    """Consecutive missing hours -> request ranges, at most ``max_hours`` long.

    Output: source, batch_start, batch_end, n_hours, start_key, end_key
    (keys in the export API's ``yyyyMMdd'T'HH`` style).
    """
    isl = islands(missing)
    if max_hours is not None:
        if max_hours < 1:
            raise ValueError("max_hours must be >= 1")
        n_chunks = F.ceil(F.col("n_hours") / F.lit(max_hours)).cast("int")
        k = F.col("__k")
        chunk_start = F.col("batch_start") + F.make_dt_interval(F.lit(0), (k * max_hours).cast("int"))
        chunk_n = F.least(F.lit(max_hours).cast("bigint"), F.col("n_hours") - k * max_hours)
        isl = (isl.select("*", F.explode(F.sequence(F.lit(0), n_chunks - 1)).alias("__k"))
                  .select(SRC, chunk_start.alias("batch_start"),
                          (chunk_start + F.make_dt_interval(F.lit(0), (chunk_n - 1).cast("int"))).alias("batch_end"),
                          chunk_n.alias("n_hours")))
    return isl.select(SRC, "batch_start", "batch_end", F.col("n_hours").cast("bigint").alias("n_hours"),
                      format_hour("batch_start", "api").alias("start_key"),
                      format_hour("batch_end", "api").alias("end_key"))


def ledger(present: DataFrame, start, end, sources: DataFrame | None = None,
           known_empty: DataFrame | None = None) -> DataFrame:
    """``(source, n_required, missing)``: per source the hours of ``[start, end]``
    that are neither present nor known to be empty, in order.

    ``sources`` adds sources that have no hour at all; by default they are
    those of ``present``.
    """
    have = _covered(present, known_empty)
    if sources is not None:
        have = have.unionByName(sources.select(F.col(SRC).cast("string").alias(SRC),
                                               F.lit(None).cast("timestamp_ntz").alias(HOUR)))
    wanted = hour_range(_lit_ts(start), _lit_ts(end))
    within = F.col(HOUR).between(trunc_hour(_lit_ts(start)), _lit_ts(end))
    return (have.select(SRC, F.when(within, F.col(HOUR)).alias(HOUR)).distinct()
                .groupBy(SRC).agg(F.collect_list(HOUR).alias("__have"))
                .select(SRC, F.size(wanted).cast("bigint").alias("n_required"),
                        F.array_except(wanted, "__have").alias("missing")))


def ledger_missing(rows: DataFrame) -> DataFrame:
    """The missing hours of a :func:`ledger` as ``(source, hour)`` rows."""
    return rows.select(SRC, F.explode("missing").alias(HOUR))


def data_range(present: DataFrame):
    """First and last present hour (two values), the default audited range."""
    return tuple(present.agg(F.min(HOUR), F.max(HOUR)).first())


def resume_points(sources: DataFrame | None, present: DataFrame, start, end,
                  known_empty: DataFrame | None = None) -> DataFrame:
    """Per source: the hour to resume fetching from.

    That is the first missing hour of ``[start, end]``: the hour after the
    continuous present prefix, or ``start`` itself when the first hour is
    missing.  With full coverage it is ``end + 1h``; an empty range
    (``start`` after ``end``) resumes at ``start``.
    """
    first, last = trunc_hour(_lit_ts(start)), trunc_hour(_lit_ts(end))
    done = F.when(first > last, first).otherwise(last + F.expr("INTERVAL 1 HOUR"))
    return (ledger(present, start, end, sources, known_empty)
            .select(SRC, F.coalesce(F.get("missing", F.lit(0)), done).alias("resume_hour"))
            .withColumn("resume_key", format_hour("resume_hour", "api")))


def coverage_report(sources: DataFrame | None, present: DataFrame, start, end,
                    max_hours: int | None = None, known_empty: DataFrame | None = None) -> DataFrame:
    """Per source: required, present (or known empty), missing hours and
    request batches, all from one ledger row per source.

    A batch starts at a missing hour whose predecessor is not missing, and
    with a cap also every ``max_hours`` hours within a run.
    """
    hour = F.expr("INTERVAL 1 HOUR")
    runs = F.aggregate(
        "missing",
        F.struct(F.lit(None).cast("timestamp_ntz").alias("last"), F.lit(0).cast("bigint").alias("length"), F.lit(0).cast("bigint").alias("n")),
        lambda a, h: F.when((a["last"] + hour == h) & (F.lit(max_hours is None) | (a["length"] < F.lit(max_hours or 0))),
                            F.struct(h.alias("last"), (a["length"] + 1).alias("length"), a["n"].alias("n")))
                      .otherwise(F.struct(h.alias("last"), F.lit(1).cast("bigint").alias("length"), (a["n"] + 1).alias("n"))))
    missing = F.size("missing").cast("bigint")
    return ledger(present, start, end, sources, known_empty).select(
        SRC, F.col("n_required").alias("required_hours"), (F.col("n_required") - missing).alias("present_hours"),
        missing.alias("missing_hours"), runs["n"].alias("batches"))

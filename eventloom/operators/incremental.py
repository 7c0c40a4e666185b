"""Incremental loads: high-water mark, upsert on a unique key, session
rebuilds and schema sync.

Plain Parquet has no MERGE, so an upsert is expressed relationally:
``target ▷ increment ∪ increment`` (anti join on the key, then union).
:func:`upsert` applies it to a folder table and, when the table is
partitioned, rewrites only the partitions the increment touches.  Keys and
partition values are matched NULL-safely throughout.
"""

from __future__ import annotations

import datetime as _dt
import uuid as _uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from eventloom.functions.hours import ntz_lit
from eventloom.functions.keys import surrogate_key
from eventloom.operators import facts
from eventloom.operators.facts import SESSION_KEYS, ordered_listagg
from eventloom.operators.latest import latest_per_key

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

# --------------------------------------------------------------------------
# high-water mark
# --------------------------------------------------------------------------


def high_water_mark(target: DataFrame | None, col: str):
    """``max(col)`` of the target (one pruned column, one row), or None
    when there is no target or it is empty."""
    if target is None:
        return None
    return target.agg(F.max(col).alias("m")).first()["m"]


def since_high_water_mark(source: DataFrame, target: DataFrame | None, source_ts: str = "event_time",
                          target_ts: str = "event_time", lookback: _dt.timedelta | None = None,
                          empty: str = "all", untimed: bool = True) -> DataFrame:
    """Rows of ``source`` strictly after the target's high-water mark.

    The mark is read first and applied as a literal, so the predicate
    reaches the Parquet scan (row-group skipping, partition pruning) instead
    of staying a scalar subquery.

    ``lookback`` re-reads a window before the mark to catch late rows (the
    upsert makes the overlap idempotent).  ``empty`` decides what a missing
    or empty target yields: ``all`` (full build) or ``none`` (zero rows, the
    warehouse behaviour of comparing with a NULL max).  Rows without a time
    lie on no side of a mark: with ``untimed`` (default) every load reads
    them again, without it they are left out, as a plain comparison does.
    """
    hwm = high_water_mark(target, target_ts)
    if hwm is None:
        if empty == "none" and target is not None:
            return source.where(F.lit(False))
        return source
    mark = hwm - lookback if lookback else hwm
    if isinstance(mark, _dt.datetime) and mark.tzinfo is None:
        lit = ntz_lit(mark)          # wall clock, independent of time zones
    else:
        lit = F.lit(mark)
    after = F.col(source_ts) > lit
    return source.where(after | F.col(source_ts).isNull() if untimed else after)


# --------------------------------------------------------------------------
# upsert
# --------------------------------------------------------------------------


def matching(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left_semi") -> DataFrame:
    """Semi or anti join on ``keys`` in which NULL equals NULL.

    Never broadcast: the keys come from Parquet files, whose compressed size is all that the
    planner goes by, and keys of a few megabytes there are hundreds in the driver."""
    other = right.select(*[F.col(k).alias(f"__m_{i}") for i, k in enumerate(keys)]).hint("merge")
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__m_{i}")) for i, k in enumerate(keys)])
    return left.join(other, on, how)


def upsert_frames(target: DataFrame, increment: DataFrame, key: str | list[str],
                  order_by: str | None = None) -> DataFrame:
    """Rows of ``increment`` replace target rows with the same key; new keys
    are appended.  ``increment`` must already be unique on ``key``.

    With ``order_by`` the replacement is *latest wins*: for a key present on
    both sides the row with the greater ``order_by`` stays (NULL greatest),
    so batches applied out of order, or twice, converge to the latest copy.
    """
    keys = [key] if isinstance(key, str) else list(key)
    kept = matching(target, increment, keys, "left_anti")
    if order_by is None:
        return kept.unionByName(increment, allowMissingColumns=True).select(*increment.columns)
    cols = increment.columns
    touched = matching(target, increment, keys).select(*cols)
    both = latest_per_key(touched.unionByName(increment.select(*cols)), keys, order_by,
                          tiebreak=[F.xxhash64(*[F.col(c) for c in cols])])
    return kept.select(*cols).unionByName(both)


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def _delete(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def _rename(spark: SparkSession, path: str, to: str) -> None:
    p, fs = _fs(spark, path)
    if not fs.rename(p, _fs(spark, to)[0]):
        raise OSError(f"could not rename {path} to {to}")


def _old(path: str) -> str:
    return f"{path.rstrip('/')}__replaced"


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None.  A swap that broke off between
    its two renames is undone first."""
    if not _exists(spark, path):
        if not _exists(spark, _old(path)):
            return None
        _rename(spark, _old(path), path)
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def _by_partition(df: DataFrame, partition_by: str) -> DataFrameWriter:
    """A partitioned write whose tasks hold few partitions each, a large one split over several:
    else every task writes a file to every partition, and files grow with tasks times partitions."""
    return df.hint("rebalance", partition_by).write.partitionBy(partition_by)


def replace_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Write ``df`` beside the table and swap it in by two renames.

    The old table stays until the new one is in its place, so a crash never
    leaves neither; ``df`` may read the table it replaces.
    """
    spark, new, old = df.sparkSession, f"{path.rstrip('/')}__new-{_uuid.uuid4().hex[:12]}", _old(path)
    (_by_partition(df, partition_by) if partition_by else df.write).mode("overwrite").parquet(new)
    if _exists(spark, path):
        _delete(spark, old)
        _rename(spark, path, old)
    _rename(spark, new, path)
    _delete(spark, old)
    spark.catalog.refreshByPath(path)


def upsert(spark: SparkSession, target_path: str, increment: DataFrame, key: str | list[str],
           partition_by: str | None = None, staging_path: str | None = None,
           order_by: str | None = None, keys_within: Column | None = None) -> dict:
    """Apply ``increment`` to the Parquet table at ``target_path``.

    * No table yet: the increment is the table (first incremental run).
    * Partitioned (``partition_by``): the increment is written once to a
      staging folder, then only ``(key, partition)`` of the target is read to
      find the partitions holding a key of the increment (a key may sit in
      another partition than its new row).  The planner knows the written
      increment's size and chooses the join.  Only touched partitions, the
      NULL one included, are rebuilt and swapped in with dynamic partition
      overwrite; untouched ones are not read.  ``keys_within``, a condition on
      the target's columns, bounds where a key's earlier row can be (for
      example the last 30 dates); by default every partition is searched.
    * Unpartitioned: full rebuild, swapped in by renames.

    The partitions are replaced one after the other, so a reader may meet a
    half-applied increment, and so may a run after a crash; applying the
    same increment again converges to the right table.
    Scratch folders are removed at the end.
    Returns a small report with the touched partition values.
    """
    from eventloom.session import scratch_path

    keys = [key] if isinstance(key, str) else list(key)
    target = read_table(spark, target_path)
    if target is None:
        (_by_partition(increment, partition_by) if partition_by else increment.write).mode("overwrite").parquet(target_path)
        return {"mode": "create", "touched": None}
    if not partition_by:
        replace_table(upsert_frames(target, increment.select(*target.columns), keys, order_by), target_path)
        return {"mode": "full", "touched": None}

    # partition values are text in folder names; their type is the increment's
    kind = increment.schema[partition_by].dataType
    target = spark.read.schema(T.StructType([
        T.StructField(f.name, kind if f.name == partition_by else f.dataType, True, f.metadata)
        for f in target.schema.fields])).parquet(target_path)
    staging_path = staging_path or scratch_path(spark, "upsert-stage")
    inc_path = f"{staging_path}-increment"
    increment.select(*target.columns).write.mode("overwrite").parquet(inc_path)
    inc = spark.read.schema(target.schema).parquet(inc_path)
    searched = target if keys_within is None else target.where(keys_within)
    # partition values, one per touched partition: bounded by the
    # number of partitions, not by rows
    touched = [r[0] for r in (matching(searched.select(*keys, partition_by), inc, keys).select(partition_by)
                              .union(inc.select(partition_by)).distinct().collect())]
    values = [v for v in touched if v is not None]
    within = F.col(partition_by).isin(values) if values else F.lit(False)
    if None in touched:
        within = within | F.col(partition_by).isNull()
    rebuilt = upsert_frames(target.where(within), inc, keys, order_by)
    _by_partition(rebuilt, partition_by).mode("overwrite").parquet(staging_path)
    staged = spark.read.schema(target.schema).parquet(staging_path).select(*target.columns)
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(partition_by).parquet(target_path))
    # a touched partition whose rows all moved elsewhere is absent from
    # the staged output; dynamic overwrite would leave it stale
    kept = {r[0] for r in staged.select(partition_by).distinct().collect()}
    for v in set(touched) - kept:
        _delete(spark, f"{target_path.rstrip('/')}/{partition_by}={NULL_PARTITION if v is None else v}")
    for scratch in (inc_path, staging_path):
        _delete(spark, scratch)
    spark.catalog.refreshByPath(target_path)
    return {"mode": "partitions", "touched": sorted(touched, key=lambda v: (v is not None, v))}


# --------------------------------------------------------------------------
# sessions
# --------------------------------------------------------------------------


def merge_sessions(old: DataFrame, new_stg: DataFrame, mode: str = "merge_partials",
                   separator: str = facts.JOURNEY_SEPARATOR) -> DataFrame:
    """Session rows to upsert for a staging increment that holds no row twice.

    ``overwrite`` (warehouse behaviour): a session already stored is
    replaced by an aggregate of only its new events.
    ``merge_partials`` (default): a touched session is combined with its
    stored row.  This is exact if every new event is strictly later than
    every stored ``session_end`` and none comes without a time or a second
    time; then min/max/sum and ``old_journey || sep || new_journey`` equal a
    rebuild from all events, and the first-event attributes stay the stored
    ones.  For late, repeated or untimed events use :func:`rebuild_sessions`.
    Only stored sessions whose key (NULL users included) occurs in the
    increment are read into the merge.
    """
    new_s = facts.sessions(new_stg, separator=separator)
    if mode == "overwrite":
        return new_s
    if mode != "merge_partials":
        raise ValueError(f"unknown mode {mode!r}")
    attrs = F.struct("user_id", "device_id", "location_id").alias("attrs")
    cols = [*SESSION_KEYS, "session_start", "session_end", "event_count", "user_journey"]
    touched = matching(old, new_s, SESSION_KEYS)
    stored, fresh = F.lit(0).alias("__new"), F.lit(1).alias("__new")
    both = (touched.select(*cols, attrs, stored)
            .unionByName(new_s.select(*cols, attrs, fresh)))
    merged = (both.groupBy(*SESSION_KEYS)
                  .agg(F.min("session_start").alias("session_start"),
                       F.max("session_end").alias("session_end"),
                       F.sum("event_count").alias("event_count"),
                       F.min_by("attrs", "__new").alias("attrs"),
                       ordered_listagg("user_journey", separator, ["__new"]).alias("user_journey")))
    return merged.select(
        surrogate_key(*SESSION_KEYS).alias("session_id"), *SESSION_KEYS,
        F.col("attrs.user_id").alias("user_id"), F.col("attrs.device_id").alias("device_id"),
        "session_start", "session_end", F.col("event_count").cast("bigint").alias("event_count"),
        "user_journey", F.col("attrs.location_id").alias("location_id"))


def rebuild_sessions(rows: DataFrame, changed: DataFrame, old: DataFrame | None = None,
                     separator: str = facts.JOURNEY_SEPARATOR) -> DataFrame:
    """Sessions that ``changed`` touches, rebuilt from all their rows: exact
    for late, repeated and untimed events alike.

    ``rows`` holds every narrow session row (:func:`facts.session_rows`),
    ``changed`` the new ones among them (or any that name the sessions).
    With ``old``, the stored sessions, rows before the earliest start of a
    touched session are pruned by a literal.
    """
    keys = changed.select(*SESSION_KEYS).distinct()
    if old is not None:
        starts = matching(old.select(*SESSION_KEYS, F.col("session_start").alias("t")), keys, SESSION_KEYS).select("t")
        first = starts.unionByName(changed.select(F.col("event_time").alias("t"))).agg(F.min("t")).first()[0]
        if first is not None:
            rows = rows.where((F.col("event_time") >= ntz_lit(first)) | F.col("event_time").isNull())
    return facts.sessions_from_rows(matching(rows, keys, SESSION_KEYS), separator)


def merge_or_rebuild_sessions(old: DataFrame, stg: DataFrame, separator: str = facts.JOURNEY_SEPARATOR) -> DataFrame:
    """Session rows to upsert for a load from whole staging: rows after the mark
    are merged as partials, and sessions with rows without a time, which lie on no
    side of a mark, are rebuilt."""
    rows = facts.session_rows(stg)
    untimed = rows.where(F.col("event_time").isNull())
    timed = since_high_water_mark(stg, old, target_ts="session_end", untimed=False)
    merged = merge_sessions(old, matching(timed, untimed.select(*SESSION_KEYS).distinct(), SESSION_KEYS, "left_anti"), separator=separator)
    return merged.unionByName(rebuild_sessions(rows, untimed, old, separator))


# --------------------------------------------------------------------------
# schema sync
# --------------------------------------------------------------------------


def sync_schema(target: DataFrame, incoming: DataFrame,
                on_schema_change: str = "sync_all_columns") -> tuple[DataFrame, DataFrame]:
    """Align a stored table with a model whose columns changed.

    Returns ``(target', incoming')`` with one column list:
    ``ignore`` keeps the target's columns (new ones dropped, missing ones
    NULL); ``fail`` raises on any difference; ``append_new_columns`` adds
    the new columns (NULL in old rows) and keeps removed ones (NULL in new
    rows); ``sync_all_columns`` makes the target's columns and types the
    model's: new columns are added as NULL, removed ones dropped, changed
    types cast.
    """
    t_types = {f.name: f.dataType for f in target.schema.fields}
    i_types = {f.name: f.dataType for f in incoming.schema.fields}
    if on_schema_change == "fail":
        if t_types != i_types:
            raise ValueError(f"schema changed: target={sorted(t_types)} incoming={sorted(i_types)}")
        return target, incoming
    if on_schema_change == "ignore":
        order = list(target.columns)
        types = t_types
    elif on_schema_change == "append_new_columns":
        order = list(target.columns) + [c for c in incoming.columns if c not in t_types]
        types = {**i_types, **t_types}
    elif on_schema_change == "sync_all_columns":
        order = list(incoming.columns)
        types = i_types
    else:
        raise ValueError(f"unknown on_schema_change {on_schema_change!r}")

    def project(df: DataFrame, have: dict) -> DataFrame:
        out: list[Column] = []
        for c in order:
            if c in have:
                col = F.col(c) if have[c] == types[c] else F.col(c).cast(types[c])
            else:
                col = F.lit(None).cast(types[c])
            out.append(col.alias(c))
        return df.select(*out)

    return project(target, t_types), project(incoming, i_types)

"""Registered queries: one callable per operator/model, (spark, sf_dir) -> DataFrame.

Every query starts from the driver's tables (the adapter turns ``events``
into raw VARIANT events), so its work grows with the data.  VARIANT
columns leave Spark as canonical JSON text.

A query works on a :class:`Workspace`, which writes staging and the
dimensions as tables under the shared checkpoint dir, each once, as a build
run does.  Every call of a query makes a workspace of its own; callers that
run many queries over the same input (the benchmark, tests) may share one.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom import streaming as stream
from eventloom.streaming import keyed
from eventloom.functions import hours as H
from eventloom.functions.keys import canonical_json, email_domain, surrogate_key
from eventloom.operators import check_state
from eventloom.operators import coverage as cov
from eventloom.operators import dimensions as dims
from eventloom.operators import facts
from eventloom.operators import hour_bitmaps as bitmaps
from eventloom.operators import incremental as inc
from eventloom.operators import quality
from eventloom.operators.keyed_table import KeyedTable
from eventloom.operators.maintained import Dimensions
from eventloom.operators.staging import parse_events, staging_as_text, with_property_keys
from eventloom.plans import dag
from eventloom.session import scratch_path, shuffles_dropped
from eventloom.sources import archives as arch
from eventloom.sources import landing as land
from eventloom.sources.raw import raw_from_events, read_raw, read_raw_with_hour
from eventloom.sources.raw_table import land_raw_table, read_raw_table

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


class Models:
    """Model relations over one staging relation, as lazy plans."""

    def __init__(self, stg: DataFrame):
        self._stg = stg

    @property
    def stg(self) -> DataFrame:
        return self._stg

    @property
    def ips(self) -> DataFrame:
        return dims.ip_addresses(self.stg)

    @property
    def companies(self) -> DataFrame:
        return dims.companies(self.stg, self.ips)

    def users(self, attribution: str = "two_lookup") -> DataFrame:
        return dims.users(self.stg, self.ips, self.companies, attribution=attribution)


class Workspace(Models):
    """Models over one input, with staging and the dimensions others depend on
    (ip_addresses, companies, users) as written tables: planning sees their
    size (static broadcast when small), lineage stays short, and JSON is
    parsed once."""

    def __init__(self, spark: SparkSession, sf_dir: str, shared: bool = True):
        self.spark, self.sf_dir, self.shared = spark, sf_dir, shared
        self._tables: dict[str, DataFrame] = {}
        self._paths: dict[str, str] = {}

    def written(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._tables:
            path = self._paths[name] = scratch_path(self.spark, name)
            build().write.mode("overwrite").parquet(path)
            self._tables[name] = self.spark.read.parquet(path)
        return self._tables[name]

    def release(self, name: str) -> None:
        """Delete a written table that the rest of the query does not read (asked for once more, it is
        written anew).  In a shared workspace it stays, for other queries."""
        if not self.shared and self._tables.pop(name, None) is not None:
            inc._delete(self.spark, self._paths.pop(name))

    @property
    def raw(self) -> DataFrame:
        """The raw events as a view: building them anew for each pass over them."""
        return raw_from_events(self.table("events"))

    @property
    def raw_keyed(self) -> DataFrame:
        """Raw events with their hour, as a written table.  Landings pass over them several
        times with a filter each; over a view, Spark moves such a filter below the adapter's
        exchange, where it builds and parses every event in the few tasks that read ``events``."""
        return self.written("raw-hours", lambda: land.with_hour_key(self.raw))

    @property
    def raw_lines(self) -> DataFrame:
        """Raw events as JSON text with their hour, as a written table: for queries that land them in
        several parts, each of which would put every stored object together and render it again."""
        return self.written("raw-lines", lambda: land.as_lines(land.with_hour_key(self.raw)))

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.sf_dir, name)

    @property
    def stg(self) -> DataFrame:
        """Typed staging, from the written lines where a query has them, else from the view."""
        raw = self.raw_lines.select(F.parse_json("value").alias("json_data")) if "raw-lines" in self._tables else self.raw
        return self.written("staging", lambda: with_property_keys(parse_events(raw)))

    @property
    def ips(self) -> DataFrame:
        return self.written("ip_addresses", lambda: dims.ip_addresses(self.stg))

    @property
    def companies(self) -> DataFrame:
        return self.written("companies", lambda: dims.companies(self.stg, self.ips))

    def users(self, attribution: str = "two_lookup") -> DataFrame:
        if attribution != "two_lookup":
            return super().users(attribution)
        return self.written("users", lambda: super(Workspace, self).users())

    @property
    def present(self) -> DataFrame:
        """Hours that hold events, per event type: the one pass that the ledger makes over the events."""
        return self.written("present", lambda: cov.present_hours(self.table("events"), "event_type", "ts"))

    def built(self) -> dict[str, DataFrame]:
        """All models as a build run leaves them for the checks."""
        if not hasattr(self, "_built"):
            given = {"raw_events": self.raw, "stg_events": self.stg, "ip_addresses": self.ips,
                     "companies": self.companies, "users": self.users()}
            self._built = dag.run(self.spark, scratch_path(self.spark, "models"), inputs=given)
        return self._built


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed staging of ``sf_dir`` as a freshly written table."""
    return Workspace(spark, sf_dir).stg


#: The queries as functions of a workspace.
STEPS: dict[str, Callable[[Workspace], DataFrame]] = {}
QUERIES: dict[str, Query] = {}


def query(step: Callable[[Workspace], DataFrame], name: str | None = None) -> Callable[[Workspace], DataFrame]:
    """Register ``step`` (named ``q_...`` unless ``name`` is given)."""
    name = name or step.__name__.removeprefix("q_")
    STEPS[name] = step
    QUERIES[name] = lambda spark, sf_dir: step(Workspace(spark, sf_dir, shared=False))
    return step


# --------------------------------------------------------------------------
# models and checks
# --------------------------------------------------------------------------


@query
def q_stg_events(w):
    return staging_as_text(w.stg)


@query
def q_ip_addresses(w):
    return dims.ip_addresses(w.stg)


@query
def q_companies(w):
    return dims.companies(w.stg, w.ips)


@query
def q_event_properties(w):
    return dims.event_properties(w.stg, properties_as="text")


@query
def q_users(w):
    return dims.users(w.stg, w.ips, w.companies)


@query
def q_users_fan_out(w):
    return w.users("fan_out")


@query
def q_users_two_lookup(w):
    """The latest rows found by aggregation instead of a window."""
    return dims.users(w.stg, w.ips, w.companies, method="aggregate")


@query
def q_sessions(w):
    return facts.sessions(w.stg)


@query
def q_events(w):
    return facts.events(w.stg, w.users())


for _name, _kinds in {"dq_not_null": ("not_null",), "dq_unique": ("unique",), "dq_relationships": ("relationships",),
                      "dq_suite": ("not_null", "unique", "relationships")}.items():
    query(lambda w, kinds=_kinds: quality.run_suite(w.built(), kinds=kinds), _name)


@query
def q_dq_suite_incremental(w):
    """The suite after the second load of events and sessions, whose checks are kept as counts
    beside each load: the second update counts that load's partitions only."""
    built, tables = w.built(), {}
    for name, key, day, time in (("events", "event_id", "event_date", "event_time"), ("sessions", "session_id", "session_date", "session_start")):
        tables[name] = t = KeyedTable(w.spark, scratch_path(w.spark, f"checked-{name}"), key, day)
        mark = F.lit(SEED_MARK).cast("timestamp_ntz")
        first = F.coalesce(F.col(time) <= mark, F.lit(True))
        for part in (first, ~first):
            t.upsert(built[name].where(part))
            check_state.update(t, name)
    return check_state.run_suite(tables, {n: df for n, df in {**built, "raw_events": w.raw, "stg_events": w.stg}.items() if n not in tables})


# --------------------------------------------------------------------------
# hour-coverage ledger (source = event_type over the events table); the
# audited range is that of the data unless a caller names another
# --------------------------------------------------------------------------

# The mark splitting seed/increment, and the cap on a batch.
SEED_MARK = "2024-01-15 03:00:00"
BATCH_CAP = 1


def _range(w, start=None, end=None):
    first, last = cov.data_range(w.present) if start is None or end is None else (start, end)
    return start or first, end or last


@query
def q_hours_required(w, start=None, end=None):
    return cov.required_hours(w.present, *_range(w, start, end))


@query
def q_hours_missing(w, start=None, end=None):
    return cov.ledger_missing(cov.ledger(w.present, *_range(w, start, end)))


@query
def q_hour_batches(w, cap=None):
    return cov.batch_hours(q_hours_missing(w), cap)


@query
def q_hour_batches_capped(w):
    return q_hour_batches(w, BATCH_CAP)


@query
def q_resume_points(w, start=None, end=None):
    return cov.resume_points(None, w.present, *_range(w, start, end))


@query
def q_coverage_report(w, start=None, end=None):
    return cov.coverage_report(None, w.present, *_range(w, start, end))


def _stored_ledger(w):
    """Two landings that overlap, each adding its hours to the stored ledger."""
    path = scratch_path(w.spark, "hour-ledger")
    mark = F.lit(SEED_MARK).cast("timestamp_ntz")
    for part in (F.col("ts") <= mark, F.col("ts") > F.expr(f"timestamp_ntz'{SEED_MARK}' - interval 2 days")):
        bitmaps.record(cov.present_hours(w.table("events").where(part), "event_type", "ts"), path)
    return bitmaps.ledger(w.spark, path)


@query
def q_hours_missing_stored(w):
    """Missing hours by bit tests on the stored ledger; no event is read again."""
    return bitmaps.missing(_stored_ledger(w), *_range(w))


@query
def q_coverage_report_stored(w):
    """The coverage report from the stored ledger."""
    start, end = _range(w)
    return cov.coverage_report(None, bitmaps.hours(_stored_ledger(w), start, end), start, end)


@query
def q_hours_per_source(w):
    return bitmaps.counts(_stored_ledger(w))


def _local_remote(w):
    stg = w.stg
    local = cov.present_hours(stg, "event_type", "event_time")
    remote = cov.present_hours(stg.where(F.col("event_time") <= F.lit(SEED_MARK).cast("timestamp_ntz")),
                               "event_type", "event_time")
    return local, remote


@query
def q_hours_publishable(w):
    return cov.publishable(*_local_remote(w))


@query
def q_hours_discardable(w):
    return cov.discardable(*_local_remote(w))


@query
def q_hour_key_roundtrip(w):
    hrs = w.present.select(cov.HOUR).distinct()
    short = F.concat(F.substring(F.col(cov.HOUR).cast("string"), 1, 10), F.lit("_"), F.hour(cov.HOUR).cast("string"))
    return hrs.select(
        cov.HOUR,
        H.format_hour(cov.HOUR, "file").alias("file_key"),
        H.format_hour(cov.HOUR, "api").alias("api_key"),
        H.parse_hour(H.format_hour(cov.HOUR, "file")).alias("parsed_file"),
        H.parse_hour(H.format_hour(cov.HOUR, "api")).alias("parsed_api"),
        H.parse_hour(H.format_hour(cov.HOUR, "space")).alias("parsed_space"),
        H.parse_hour(short).alias("parsed_short"))


@query
def q_archive_names_to_hours(w):
    """Archive member names in the three observed styles, mapped back to keys."""
    ev = w.table("events")
    d = F.substring(F.col("ts").cast("string"), 1, 10)
    h1 = F.hour("ts").cast("string")
    uid = F.col("user_id").cast("string")
    style = F.col("event_id") % 3
    name = (F.when(style == 0, F.concat(uid, F.lit("/"), uid, F.lit("_"), d, F.lit("_"), h1,
                                        F.lit("#"), F.col("event_id").cast("string"), F.lit(".json.gz")))
             .when(style == 1, F.concat(d, F.lit("_"), h1, F.lit(".json.gz")))
             .otherwise(F.concat(uid, F.lit("_"), d, F.lit("_"), F.lpad(h1, 2, "0"), F.lit("#x.json.gz"))))
    return (ev.select(name.alias("member_name")).distinct()
              .select("member_name", H.hour_key_from_name("member_name").alias("hour_key")))


@query
def q_default_window(w):
    start, end = H.default_window_cols("ts")
    return w.table("events").select("event_id", start.alias("window_start"), end.alias("window_end"),
                                    F.size(H.hour_range(start, end)).cast("bigint").alias("n_hours"))


@query
def q_surrogate_keys(w):
    return w.stg.select(
        "uuid", "event_time",
        surrogate_key("uuid").alias("k_uuid"),
        surrogate_key("session_id_raw", "amplitude_id").alias("k_session"),
        surrogate_key("city", "region", "country").alias("k_location"),
        surrogate_key("ip_address").alias("k_ip"),
        surrogate_key("device_type", "uuid").alias("k_null_first"))


@query
def q_consumer_domain_filter(w):
    dom = email_domain("user_id")
    return (w.stg.where(F.col("user_id").contains("@")).select("user_id").distinct()
             .select("user_id", dom.alias("email_domain"),
                     (~dom.isin(*dims.CONSUMER_DOMAINS)).alias("is_company")))


@query
def q_latest_per_key_maxby(w):
    return dims.latest_user_rows(w.stg, method="aggregate")


@query
def q_latest_per_key_window(w):
    return dims.latest_user_rows(w.stg, method="window")


@query
def q_events_maxby(w):
    return facts.events(w.stg, w.users(), method="aggregate")


# --------------------------------------------------------------------------
# incremental loads: seed with rows up to SEED_MARK, then apply the rest
# --------------------------------------------------------------------------


def _seed_split(stg: DataFrame) -> DataFrame:
    """What a first load sees: rows up to the mark, and those without a time."""
    mark = F.lit(SEED_MARK).cast("timestamp_ntz")
    return stg.where((F.col("event_time") <= mark) | F.col("event_time").isNull())


@query
def q_events_incremental(w, lookback=None):
    """Seed the event fact, then load everything after its high-water mark
    and upsert on event_id.  Users come from full staging in both steps."""
    usr = w.users()
    target = w.written("events-seed", lambda: facts.events(_seed_split(w.stg), usr))
    new_rows = inc.since_high_water_mark(w.stg, target, lookback=lookback)
    increment = w.written(f"events-increment-{lookback}", lambda: facts.events(new_rows, usr))
    return inc.upsert_frames(target, increment, "event_id")


@query
def q_events_lookback(w):
    return q_events_incremental(w, lookback=_dt.timedelta(hours=6))


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumn("event_date", F.to_date("event_time"))


@query
def q_events_incremental_table(w):
    """Same load into a versioned table partitioned by event date: key filters name the
    partitions to search, and only those that the increment touches are rewritten."""
    usr = w.users()
    out = KeyedTable(w.spark, scratch_path(w.spark, "events-table"), "event_id", "event_date")
    out.upsert(_dated(facts.events(_seed_split(w.stg), usr)))
    new_rows = inc.since_high_water_mark(w.stg, out.read())
    out.upsert(_dated(facts.events(new_rows, usr)))
    return out.read().drop("event_date")


@query
def q_events_moved_keys(w):
    """Every third event is first stored under a date some days off, or none; its
    true row is upserted in the second load and leaves no other copy behind."""
    ev = w.written("events-model", lambda: _dated(facts.events(w.stg, w.users())))
    off = F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0
    wrong = F.when(F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0, F.date_add("event_date", 3))
    out = KeyedTable(w.spark, scratch_path(w.spark, "events-moved"), "event_id", "event_date")
    out.upsert(ev.where(~off).unionByName(ev.where(off).withColumn("event_date", wrong)))
    out.upsert(ev.where(off))
    return out.read().drop("event_date")


@query
def q_events_table_version(w):
    """A table after two loads, read as its first load left it."""
    ev = w.written("events-model", lambda: _dated(facts.events(w.stg, w.users())))
    out = KeyedTable(w.spark, scratch_path(w.spark, "events-versions"), "event_id", "event_date")
    out.upsert(ev)
    out.upsert(ev.where(F.pmod(F.xxhash64("event_id"), F.lit(5)) == 0).withColumn("company_name", F.lit("changed")))
    out.vacuum(keep=2)
    return out.read(version=1).drop("event_date")


@query
def q_events_upsert_null_time(w):
    """The untimed events are stored first, alone in the NULL partition; then
    everything is upserted in two parts, each of which meets that partition."""
    usr = w.users()
    path = scratch_path(w.spark, "events-untimed")
    for part in (F.col("event_time").isNull(), F.col("event_id_raw") % 2 == 0, F.col("event_id_raw") % 2 == 1):
        inc.upsert(w.spark, path, _dated(facts.events(w.stg.where(part), usr)), "event_id", "event_date", order_by="event_time")
    return w.spark.read.parquet(path).drop("event_date")


@query
def q_sessions_incremental_merge(w):
    """Partials merged over the mark; sessions with events without a time, which lie on
    no side of it, are rebuilt."""
    seed = w.written("sessions-seed", lambda: facts.sessions(_seed_split(w.stg)))
    return inc.upsert_frames(seed, inc.merge_or_rebuild_sessions(seed, w.stg), "session_id")


@query
def q_sessions_incremental_overwrite(w):
    """The warehouse's load: a comparison with the mark, which rows without a time never
    pass, and sessions replaced by the aggregate of their new rows."""
    seed = w.written("sessions-seed", lambda: facts.sessions(_seed_split(w.stg)))
    new_rows = inc.since_high_water_mark(w.stg, seed, target_ts="session_end", untimed=False)
    return inc.upsert_frames(seed, inc.merge_sessions(seed, new_rows, "overwrite"), "session_id")


@query
def q_sessions_merge_null_user(w):
    """All sessions, where those of unknown users, whose key is NULL, are first stored up to
    the mark and then merged with the rest of their events."""
    unknown = F.col("amplitude_id").isNull()
    first = _seed_split(w.stg.where(unknown)).unionByName(w.stg.where(~unknown))
    seed = w.written("unknown-seed", lambda: facts.sessions(first))
    later = inc.since_high_water_mark(w.stg.where(unknown), facts.sessions(_seed_split(w.stg.where(unknown))), target_ts="session_end", untimed=False)
    rows, untimed = facts.session_rows(w.stg), facts.session_rows(w.stg).where("event_time is null")
    merged = inc.merge_sessions(seed, inc.matching(later, untimed.select(*facts.SESSION_KEYS).distinct(), facts.SESSION_KEYS, "left_anti"))
    return inc.upsert_frames(seed, merged.unionByName(inc.rebuild_sessions(rows, untimed, seed)), "session_id")


def _maintained(w):
    """The dimensions after three loads: some rows up to the mark, the later ones, then the
    late and untimed rest."""
    if not hasattr(w, "_maintained"):
        kept = Dimensions(w.spark, scratch_path(w.spark, "maintained"), buckets=8)
        mark = F.lit(SEED_MARK).cast("timestamp_ntz")
        late = (F.col("event_id_raw") % 4 == 0) | F.col("event_time").isNull() | F.col("event_id_raw").isNull()
        for part in (~late & (F.col("event_time") <= mark), ~late & (F.col("event_time") > mark), late):
            kept.load(w.stg.where(part))
        w._maintained = kept.tables()
    return w._maintained


@query
def q_users_maintained(w):
    return _maintained(w)["users"]


@query
def q_companies_maintained(w):
    return _maintained(w)["companies"]


@query
def q_ip_addresses_maintained(w):
    return _maintained(w)["ip_addresses"]


@query
def q_event_properties_maintained(w):
    t = _maintained(w)["event_properties"]
    return t.withColumn("properties_json", canonical_json("properties_json"))


@query
def q_sessions_incremental_merge_whole(w):
    """Partials merged over the mark, over whole staging: events without a time
    are in the first load, and their sessions are rebuilt in the second."""
    seed = w.written("sessions-seed-whole", lambda: facts.sessions(_seed_split(w.stg)))
    return inc.upsert_frames(seed, inc.merge_or_rebuild_sessions(seed, w.stg), "session_id")


@query
def q_sessions_merge_whole_late_untimed(w):
    """The same, where all events without a time arrive after the first load."""
    seed = w.written("sessions-seed-timed", lambda: facts.sessions(_seed_split(w.stg.where(F.col("event_time").isNotNull()))))
    return inc.upsert_frames(seed, inc.merge_or_rebuild_sessions(seed, w.stg), "session_id")


def _run_twice(w, name, first, models, **options):
    """A build over ``first``, then one over all of staging, into the same tables."""
    out = scratch_path(w.spark, name)
    dag.run(w.spark, out, inputs={"stg_events": first}, models=models)
    dag.run(w.spark, out, inputs={"stg_events": w.stg}, models=models, **options)
    return w.spark.read.parquet(f"{out}/{models[0]}")


@query
def q_sessions_incremental_table(w):
    """The runner's session table, partitioned by start date."""
    return _run_twice(w, "sessions-table", _seed_split(w.stg), ["sessions"]).drop("session_date")


@query
def q_sessions_lookback(w):
    """Every tenth event up to the mark arrives late; a lookback to the first
    event picks it up and counts the others once."""
    on_time = _seed_split(w.stg).where(F.col("event_id_raw") % 10 != 0)
    return _run_twice(w, "sessions-late", on_time, ["sessions"], lookback=_dt.timedelta(days=60)).drop("session_date")


@query
def q_schema_sync(w):
    """The runner meets a stored session table that predates ``location_id``,
    still has a dropped column, and counts in another type; the increment is
    the warehouse's (``overwrite``)."""
    out = scratch_path(w.spark, "schema-sync")
    stored = (facts.sessions(_seed_split(w.stg)).drop("location_id").withColumn("legacy_channel", F.lit("web"))
              .withColumns({"event_count": F.col("event_count").cast("int"), "session_date": F.to_date("session_start")}))
    inc.replace_table(stored, f"{out}/sessions", "session_date")
    t = dag.run(w.spark, out, inputs={"stg_events": w.stg}, models=["sessions"], session_mode="overwrite")
    return t["sessions"].drop("session_date")


# --------------------------------------------------------------------------
# the build runner: parents' tables, views, layers, full refresh, descriptions
# --------------------------------------------------------------------------


@query
def q_run_from_stored_parents(w):
    """One model built by itself, in a later run: its parents are read from their tables."""
    out = scratch_path(w.spark, "run-parents")
    dag.run(w.spark, out, inputs={"stg_events": w.stg}, models=["ip_addresses", "companies"])
    return dag.run(w.spark, out, inputs={"stg_events": w.stg}, models=["users"])["users"]


@query
def q_run_with_parents(w):
    """The same model with all it depends on, in one run."""
    return dag.run(w.spark, scratch_path(w.spark, "run-upstream"), inputs={"raw_events": w.raw}, models=["users"], with_parents=True)["users"]


@query
def q_published_views(w):
    """SQL over the built models as temporary views: events and journeys by company."""
    dag.register_views({"events": w.built()["events"], "sessions": w.built()["sessions"]}, prefix="v_")
    return w.spark.sql("""
        select e.company_name, count(*) n_events, count(distinct s.session_id) n_sessions,
               max(s.event_count) longest
        from v_events e left join v_sessions s on s.session_id = e.session_id group by e.company_name""")


@query
def q_run_layer(w):
    """The selector of a layer: what a run of ``silver`` builds, with its rows."""
    built = dag.run(w.spark, scratch_path(w.spark, "run-layer"), inputs={"stg_events": w.stg}, models=["silver"])
    names = [n for n in built if n != "stg_events"]
    return reduce(DataFrame.unionByName, [built[n].agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("model"), "n_rows") for n in names])


@query
def q_run_full_refresh(w):
    """Tables built from every fifth event, then refreshed in full: nothing of the first run stays."""
    out = scratch_path(w.spark, "run-refresh")
    given = {"ip_addresses": w.ips, "companies": w.companies, "users": w.users()}
    some = w.stg.where(F.pmod(F.xxhash64("uuid"), F.lit(5)) == 0).withColumn("event_time", F.expr("event_time + interval 400 days"))
    dag.run(w.spark, out, inputs={"stg_events": some, **given}, models=["events"])
    return dag.run(w.spark, out, inputs={"stg_events": w.stg, **given}, models=["events"], full_refresh=True)["events"].drop("event_date")


@query
def q_described_columns(w):
    """The session table's columns as its files describe them, with how many rows have a value."""
    t = w.built()["sessions"].drop("session_date")
    known = t.agg(*[F.count(c).alias(c) for c in t.columns])
    rows = F.array(*[F.struct(F.lit(f.name).alias("column"), F.lit(f.metadata.get("comment")).alias("comment"), F.col(f.name).alias("n_known"))
                     for f in t.schema.fields])
    return known.select(F.inline(rows))


# --------------------------------------------------------------------------
# landing, archives and streaming (all write under the checkpoint dir)
# --------------------------------------------------------------------------


def _before_mark(raw: DataFrame, before: bool) -> DataFrame:
    """Raw events (objects or lines) with their hour, before the mark's hour or not.  Keys of four-digit
    years are in the order of time; other events are told by their time inside the object."""
    event = F.col("json_data") if "json_data" in raw.columns else F.try_parse_json("value")
    ts = F.try_variant_get(event, "$.event_time", "timestamp_ntz")
    mark, key = H.trunc_hour(F.lit(SEED_MARK).cast("timestamp_ntz")), F.col(land.HOUR_KEY)
    early = F.when(key.like(r"____-__-__\___"), key < H.format_hour(mark)).otherwise(ts < mark)
    return raw.where(early) if before else raw.where(~early | early.isNull())


@query
def q_raw_landed_hours(w):
    """Land raw events one folder per hour, read them back with the hour
    taken from the folder name."""
    path = scratch_path(w.spark, "landed")
    land.land_hours(w.raw_keyed, path)
    return parse_events(read_raw_with_hour(w.spark, path)).select("uuid", "event_time", "hour")


@query
def q_flat_hour_files(w):
    """One flat ``YYYY-MM-DD_HH.jsonl`` per hour, read back with the hour
    taken from the file name."""
    path = scratch_path(w.spark, "flat")
    land.land_flat_hours(w.raw_keyed, path).write.format("noop").mode("overwrite").save()
    return parse_events(read_raw_with_hour(w.spark, path)).select("uuid", "event_time", "hour")


@query
def q_land_new_hours(w):
    """Land the hours before the mark, then offer everything, twice: only hours
    not yet landed are written, so each row lands exactly once, and rows
    without an hour are neither lost nor repeated."""
    path = scratch_path(w.spark, "landed-new")
    raw = w.raw_keyed
    land.land_hours(_before_mark(raw, True), path)
    land.land_new_hours(w.spark, raw, path)
    land.land_new_hours(w.spark, raw, path)
    return parse_events(read_raw(w.spark, path)).select("uuid", "event_time", "hour_key")


def _raw_table(w):
    path = scratch_path(w.spark, "raw-table")
    land_raw_table(w.raw_keyed, path)
    return read_raw_table(w.spark, path)


@query
def q_raw_table_staging(w):
    """Raw events stored as VARIANT, staging read from the shredded columns of all 29 fields."""
    return staging_as_text(parse_events(_raw_table(w), lookup="fields").drop("hour_key"))


@query
def q_raw_table_sessions(w):
    """Sessions straight from the stored raw table: the scan reads the fields sessions use."""
    return facts.sessions(parse_events(_raw_table(w), lookup="fields"))


@query
def q_raw_table_landed_again(w):
    """The hours before the mark, then everything, twice: an hour landed again replaces itself,
    and rows without an hour come once."""
    path = scratch_path(w.spark, "raw-table-again")
    raw = w.raw_keyed
    for part in (_before_mark(raw, True), raw, raw):
        land_raw_table(part, path)
    return parse_events(read_raw_table(w.spark, path), lookup="fields").select("uuid", "event_time", "hour_key")


@query
def q_archive_unpack(w):
    """Write the raw events as hourly ZIP-of-gzip archives, then unpack
    them: members dealt over the tasks, member name -> hour key."""
    path = scratch_path(w.spark, "archives")
    arch.write_archives(w.raw, path).write.format("noop").mode("overwrite").save()
    stg = parse_events(arch.unpack_archives(w.spark, path))
    return stg.select("uuid", "event_time", F.when(F.col("hour").isNotNull(), F.col("hour_key")).alias("hour_key"))


def _dedupe(w, first, second, files=None):
    """Two landings, streamed one after the other through one checkpoint; the rows kept,
    with whether they came late."""
    path, out, ckpt = (scratch_path(w.spark, n) for n in ("stream-dedupe-src", "stream-dedupe", "stream-dedupe-ckpt"))
    for part in (first, second):
        land.land_hours(part, path)
        src = stream.stream_staging(w.spark, path, max_files_per_trigger=files)
        keyed.start_dedupe(src, out, ckpt).awaitTermination()
    columns = ["uuid", "amplitude_id", "event_type", "event_id_raw"]
    kept = keyed.unique_table(w.spark, out).read()
    return w.stg.select(*columns, F.lit(False).alias("late")).limit(0) if kept is None else kept.select(*columns, "late")


@query
def q_stream_dedupe(w):
    raw = w.raw_lines
    return _dedupe(w, _before_mark(raw, True), _before_mark(raw, False)).drop("late")


@query
def q_stream_dedupe_late(w):
    """Later hours land first: what comes behind the watermark is kept and marked, and the
    table holds every uuid once."""
    raw = w.raw_lines
    return _dedupe(w, _before_mark(raw, False), _before_mark(raw, True))


def _land_and_stream(w, start, table, parts, files=None, checkpoints=None):
    """Land each part, then run the stream over what has landed; several checkpoints
    make it several streams, each over a landing of its own.  Landed text is most of
    what such a query stores, so it is compressed, and the lines go when all have landed."""
    out = scratch_path(w.spark, "stream-out")
    source, ckpt = scratch_path(w.spark, "stream-src"), scratch_path(w.spark, "stream-ckpt")
    for i, part in enumerate(parts):
        path, own = (f"{source}-{i}", f"{ckpt}-{i}") if checkpoints else (source, ckpt)
        with shuffles_dropped(w.spark):
            land.land_hours(part, path, compression="gzip")
        if i == len(parts) - 1:
            w.release("raw-lines")
        start(stream.stream_staging(w.spark, path, max_files_per_trigger=files), out, own).awaitTermination()
    return table(w.spark, out).read()


@query
def q_stream_events_upsert(w):
    """Hourly cadence: land the hours before the mark, run the stream,
    land the rest, run it again (several micro-batches); each batch is
    upserted on event_id, latest copy wins."""
    raw, users = w.raw_lines, w.users()
    w.release("staging")
    start = lambda src, out, ckpt: keyed.start_events(src, out, ckpt, users)
    return _land_and_stream(w, start, keyed.events_table, [_before_mark(raw, True), _before_mark(raw, False)], files=400).drop("event_date")


@query
def q_stream_two_checkpoints(w):
    """Two streams, each with its own source and checkpoint, into one table."""
    raw, users = w.raw_lines, w.users()
    even = F.try_variant_get(F.try_parse_json("value"), "$.event_id", "bigint") % 2 == 0
    start = lambda src, out, ckpt: keyed.start_events(src, out, ckpt, users)
    return _land_and_stream(w, start, keyed.events_table, [raw.where(even), raw.where(~even)], checkpoints=True).drop("event_date")


@query
def q_stream_sessions_upsert(w):
    raw = w.raw_lines
    return _land_and_stream(w, keyed.start_sessions, keyed.sessions_table,
                            [_before_mark(raw, True), _before_mark(raw, False)]).drop("session_date")


@query
def q_stream_sessions_out_of_order(w):
    """Later hours land first, and files fall into several micro-batches."""
    raw = w.raw_lines
    return _land_and_stream(w, keyed.start_sessions, keyed.sessions_table,
                            [_before_mark(raw, False), _before_mark(raw, True)], files=400).drop("session_date")

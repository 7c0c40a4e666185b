"""Fact models: sessions and the deduplicated event fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.hours import trunc_hour, trunc_minute
from eventloom.functions.keys import surrogate_key
from eventloom.operators.latest import latest_per_key
from eventloom.operators.staging import EVENT_PROPERTIES_KEY, USER_PROPERTIES_KEY, json_path, with_property_keys

# The page-path property that forms the session journey and
# the journey separator.
PAGE_PATH_KEY = "[Amplitude] Page Path"
JOURNEY_SEPARATOR = " > "

SESSION_KEYS = ["session_id_raw", "amplitude_id"]
SESSION_COLUMNS = ["session_id", "session_id_raw", "amplitude_id", "user_id", "device_id",
                   "session_start", "session_end", "event_count", "user_journey", "location_id"]
EVENT_COLUMNS = ["event_id", "event_id_raw", "session_id", "session_id_raw", "amplitude_id",
                 "ip_address_id", "event_time", "event_type", "user_properties_id",
                 "event_properties_id", "company_name", "uuid"]


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ordered_listagg(value: str, separator: str, order_by: list[str]):
    """``listagg(value, sep) WITHIN GROUP (ORDER BY ...)`` (SQL-only syntax)."""
    order = ", ".join(f"`{c}` ASC" for c in order_by)
    return F.expr(f"listagg(`{value}`, {_sql_str(separator)}) WITHIN GROUP (ORDER BY {order})")


#: Events without a time are ordered by their raw id; a slice of them holds ids of one such range.
UNTIMED_SLICE_IDS = 4096


def session_rows(stg: DataFrame, dedupe: bool = False) -> DataFrame:
    """Narrow per-event input of the session build: keys, the user
    attributes, time, tiebreaks and page path (the only VARIANT read)."""
    src = stg
    if dedupe:
        src = latest_per_key(stg, ["uuid"], "event_time", tiebreak=["event_id_raw"])
    page = F.coalesce(F.try_variant_get(F.col("event_properties"), json_path(PAGE_PATH_KEY), "string"),
                      F.lit(""))
    # tiebreak for equal event times: the raw id, then an 8-byte hash of the
    # uuid, which travels through the shuffle instead of the uuid string
    return (src.where(F.col("session_id_raw").isNotNull())
               .select(*SESSION_KEYS, "user_id", "device_id", "city", "region", "country",
                       "event_time", F.col("event_id_raw").alias("eid"),
                       F.xxhash64(F.coalesce("uuid", F.lit(""))).alias("tb"), page.alias("page")))


def session_partials(rows: DataFrame, separator: str = JOURNEY_SEPARATOR,
                     split_by: str | None = "minute") -> DataFrame:
    """Per (session, time slice) partial aggregates.

    Splitting a session by the minute (or hour) of its events lets a huge
    session be sorted and concatenated by many tasks; slices are then
    joined in time order, which equals one ordered string aggregation
    because every slice holds at least one event.  Events without a time come
    first, ordered by raw id, in slices of id ranges.
    """
    order = ["event_time", "eid", "tb"]
    first_attrs = F.min_by(F.struct("user_id", "device_id", "city", "region", "country"), F.struct(*order))
    piece = ordered_listagg("page", separator, order)
    cut = {"minute": trunc_minute, "hour": trunc_hour, None: lambda c: F.lit(None).cast("timestamp_ntz")}[split_by]
    untimed = F.floor(F.col("eid") / UNTIMED_SLICE_IDS) if split_by else F.lit(None).cast("bigint")
    return (rows.groupBy(*SESSION_KEYS, cut("event_time").alias("slice"),
                         F.when(F.col("event_time").isNull(), untimed).alias("id_slice"))
                .agg(F.min("event_time").alias("session_start"),
                     F.max("event_time").alias("session_end"),
                     F.count(F.lit(1)).alias("event_count"),
                     first_attrs.alias("first"),
                     piece.alias("user_journey")))


def combine_partials(parts: DataFrame, separator: str = JOURNEY_SEPARATOR) -> DataFrame:
    """Merge slice partials into one row per session.  Exact: min/max/sum,
    the first slice's attributes, and the slice journeys concatenated in
    order.  The order is a struct, which is never NULL, so a session whose
    events have no time keeps its attributes."""
    order = ["session_start", "id_slice"]
    return (parts.groupBy(*SESSION_KEYS)
                 .agg(F.min("session_start").alias("session_start"),
                      F.max("session_end").alias("session_end"),
                      F.sum("event_count").alias("event_count"),
                      F.min_by(F.col("first"), F.struct(*order)).alias("first"),
                      ordered_listagg("user_journey", separator, order).alias("user_journey")))


def finish_sessions(agg: DataFrame) -> DataFrame:
    f = lambda c: F.col(f"first.{c}")
    return agg.select(
        surrogate_key("session_id_raw", "amplitude_id").alias("session_id"),
        "session_id_raw", "amplitude_id",
        f("user_id").alias("user_id"), f("device_id").alias("device_id"),
        "session_start", "session_end", F.col("event_count").cast("bigint").alias("event_count"),
        "user_journey",
        surrogate_key(F.coalesce(f("city"), F.lit("")), F.coalesce(f("region"), F.lit("")),
                      F.coalesce(f("country"), F.lit(""))).alias("location_id"))


def sessions_from_rows(rows: DataFrame, separator: str = JOURNEY_SEPARATOR,
                       split_by: str | None = "minute") -> DataFrame:
    """Sessions of narrow rows (:func:`session_rows`)."""
    return finish_sessions(combine_partials(session_partials(rows, separator, split_by), separator))


def sessions(stg: DataFrame, dedupe: bool = False, separator: str = JOURNEY_SEPARATOR,
             split_by: str | None = "minute") -> DataFrame:
    """M-SE: one row per (session_id_raw, amplitude_id) with start, end,
    event count, ordered page journey and a location key.

    Faithful default: reads staging (duplicates included) and skips NULL
    session ids.  User attributes and location are taken row-consistently
    from the session's first event (a legal, deterministic ``any_value``).
    """
    return sessions_from_rows(session_rows(stg, dedupe), separator, split_by)


def event_rows(stg: DataFrame) -> DataFrame:
    """Narrow per-row input of the event fact.

    The two property keys come from staging (or are computed here, before any
    shuffle), so 32-character keys move instead of VARIANT payloads.  Keys whose inputs
    are narrower than their digest (uuid, session pair, IP) are computed
    after the shuffles, in :func:`finish_events`.
    """
    return with_property_keys(stg).select(
        "event_id_raw", "session_id_raw", "amplitude_id", "ip_address", "event_time", "event_type",
        F.col(USER_PROPERTIES_KEY).alias("user_properties_id"),
        F.col(EVENT_PROPERTIES_KEY).alias("event_properties_id"), "uuid")


def finish_events(df: DataFrame, null_fk: str = "sentinel") -> DataFrame:
    session_id = surrogate_key("session_id_raw", "amplitude_id")
    ip_id = surrogate_key("ip_address")
    if null_fk == "null":
        session_id = F.when(F.col("session_id_raw").isNotNull(), session_id)
        ip_id = F.when(F.col("ip_address").isNotNull(), ip_id)
    elif null_fk != "sentinel":
        raise ValueError(f"unknown null_fk {null_fk!r}")
    return df.select(
        surrogate_key("uuid").alias("event_id"), "event_id_raw",
        session_id.alias("session_id"), "session_id_raw", "amplitude_id",
        ip_id.alias("ip_address_id"), "event_time", "event_type", "user_properties_id",
        "event_properties_id", "company_name", "uuid")


def dedupe_events(keyed: DataFrame, method: str = "window") -> DataFrame:
    """Latest row per uuid (event_time DESC, NULLs first).  Ties on
    event_time are broken by a hash of the row, so reruns agree.
    All NULL uuids form one group, as in the warehouse model."""
    tb = F.xxhash64(*[F.col(c) for c in keyed.columns if c not in ("uuid", "event_time")])
    return latest_per_key(keyed.withColumn("__tb", tb), ["uuid"], "event_time",
                          tiebreak=["__tb"], method=method).drop("__tb")


def attach_company(ev: DataFrame, usr: DataFrame) -> DataFrame:
    """Left join events to users for ``company_name``, in one pass.

    Only users with a company can contribute, so the build side is filtered
    to those.  Rows with NULL amplitude_id can never match; instead of all
    hashing to one partition they join on ``(hash of the uuid, is_null=true)``,
    a key no user row has, spread as widely as the uuids.  (Splitting them
    into a separate branch would compute the deduplicated input twice.)
    """
    comp = (usr.where(F.col("company").isNotNull())
               .select(F.col("amplitude_id").alias("__k"), F.lit(False).alias("__null"),
                       F.col("company").alias("company_name")))
    salt = F.xxhash64("uuid")
    keyed = ev.select("*", F.coalesce(F.col("amplitude_id"), salt).alias("__k"),
                      F.col("amplitude_id").isNull().alias("__null"))
    return keyed.join(comp, ["__k", "__null"], "left").drop("__k", "__null")


def events(stg: DataFrame, usr: DataFrame, null_fk: str = "sentinel",
           method: str = "window") -> DataFrame:
    """M-EV: one row per uuid with surrogate keys and denormalised company."""
    return finish_events(attach_company(dedupe_events(event_rows(stg), method), usr), null_fk)


def refresh_company(ev: DataFrame, usr: DataFrame) -> DataFrame:
    """Re-attach ``company_name`` to stored events from the current users.

    The event fact is incremental while users are rebuilt in full, so a
    stored row keeps the company known when it was loaded; this recomputes
    it for all rows in one left join (same null-key handling as the build).
    """
    cols = ev.columns
    return attach_company(ev.drop("company_name"), usr).select(*cols)

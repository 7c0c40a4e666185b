"""M-STG: raw VARIANT -> 29 typed staging columns, 1:1 with raw rows.

Parsing happens once; downstream models should read the typed output
(materialised as Parquet in production) instead of re-walking VARIANT.
Catalyst prunes the ``variant_get`` calls a model does not use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.keys import canonical_json, surrogate_key
from eventloom.sources.raw import RAW_COL

# Staging columns in order as (output name, JSON key, type).
# "number" is resolved by ``number_type``; "variant" keeps the sub-object.
STAGING_SPEC: list[tuple[str, str, str]] = [
    ("insert_id", "$insert_id", "string"),
    ("amplitude_id", "amplitude_id", "number"),
    ("app", "app", "number"),
    ("city", "city", "string"),
    ("client_event_time", "client_event_time", "timestamp_ntz"),
    ("client_upload_time", "client_upload_time", "timestamp_ntz"),
    ("country", "country", "string"),
    ("device_family", "device_family", "string"),
    ("device_id", "device_id", "string"),
    ("device_type", "device_type", "string"),
    ("dma", "dma", "string"),
    ("event_id_raw", "event_id", "number"),
    ("event_properties", "event_properties", "variant"),
    ("event_time", "event_time", "timestamp_ntz"),
    ("event_type", "event_type", "string"),
    ("ip_address", "ip_address", "string"),
    ("language", "language", "string"),
    ("library", "library", "string"),
    ("os_name", "os_name", "string"),
    ("os_version", "os_version", "string"),
    ("platform", "platform", "string"),
    ("processed_time", "processed_time", "timestamp_ntz"),
    ("region", "region", "string"),
    ("server_received_time", "server_received_time", "timestamp_ntz"),
    ("server_upload_time", "server_upload_time", "timestamp_ntz"),
    ("session_id_raw", "session_id", "number"),
    ("user_id", "user_id", "string"),
    ("user_properties", "user_properties", "variant"),
    ("uuid", "uuid", "string"),
]

STAGING_COLUMNS = [name for name, _, _ in STAGING_SPEC]
VARIANT_COLUMNS = [name for name, _, t in STAGING_SPEC if t == "variant"]


# Further columns that a written staging table carries: canonical text and key
# of the property objects, computed once.
EVENT_PROPERTIES_TEXT = "event_properties_text"
EVENT_PROPERTIES_KEY = "event_properties_key"
USER_PROPERTIES_TEXT = "user_properties_text"
USER_PROPERTIES_KEY = "user_properties_key"
PROPERTY_COLUMNS = [EVENT_PROPERTIES_TEXT, EVENT_PROPERTIES_KEY, USER_PROPERTIES_TEXT, USER_PROPERTIES_KEY]


def json_path(key: str) -> str:
    """Variant path for one top-level key; brackets allow spaces and '$'."""
    return "$['" + key.replace("'", "\\'") + "']"


def staging_struct_type(number_type: str = "bigint") -> str:
    """DDL of all staging fields as one struct, keyed by their JSON names; times as text."""
    def ddl(t):
        return {"number": number_type, "timestamp_ntz": "string"}.get(t, t)
    return "struct<" + ", ".join(f"`{k.replace('`', '``')}`: {ddl(t)}" for _, k, t in STAGING_SPEC) + ">"


def _time(text: Column, exact: Column) -> Column:
    """A time from its text, by Spark's compiled cast.  The cast inside VARIANT (``exact``), which
    builds an expression for each value, is left for what is not text of a date, a space and more."""
    plain = F.when(text.like("____-__-__ %"), text.try_cast("timestamp_ntz"))
    return F.when(text.isNotNull(), F.coalesce(plain, exact))


def parse_events(raw: DataFrame, mode: str = "strict", number_type: str = "bigint",
                 raw_col: str = RAW_COL, lookup: str = "object") -> DataFrame:
    """Typed staging relation.

    mode: ``strict`` raises on a value that does not cast (the warehouse's
    ``::`` semantics), ``permissive`` yields NULL instead, ``quarantine``
    yields NULL and adds ``_errors array<string>`` naming the columns whose
    value was present but did not cast.
    number_type: ``bigint`` (default) or ``decimal(38,0)`` for 38-digit ids.
    Extra columns of ``raw`` besides ``raw_col`` are kept at the end.

    strict/permissive extract all 29 fields with one cast of the object to
    a struct (one walk over each object instead of 29 path lookups); a root
    that is not an object yields NULL fields, as per-path lookups would.
    quarantine looks fields up one by one to tell which failed.
    ``lookup="fields"`` does so in the other modes too: right for a stored
    VARIANT table, whose scan then reads the columns of the fields used.
    """
    if mode not in ("strict", "permissive", "quarantine"):
        raise ValueError(f"unknown mode {mode!r}")
    if lookup not in ("object", "fields"):
        raise ValueError(f"unknown lookup {lookup!r}")
    v = F.col(raw_col)
    extra = [c for c in raw.columns if c != raw_col]
    if mode != "quarantine" and lookup == "fields":
        get = F.variant_get if mode == "strict" else F.try_variant_get
        return raw.select(*[get(v, json_path(key), number_type if t == "number" else t).alias(name) for name, key, t in STAGING_SPEC],
                          *extra)
    if mode != "quarantine":
        st = staging_struct_type(number_type)
        # without raising, so that no second walk has to tell objects from other roots; what may
        # fail to cast, numbers and times, is then asked for by itself where the struct has no value
        wide = raw.select(F.try_variant_get(v, "$", st).alias("__s"), v.alias("__v"), *extra)
        get = F.variant_get if mode == "strict" else F.try_variant_get

        def field(key, t):
            c = F.col("__s").getField(key)
            if t == "timestamp_ntz":
                return _time(c, get(F.col("__v"), json_path(key), t))
            if t == "number" and mode == "strict":
                return F.coalesce(c, get(F.col("__v"), json_path(key), number_type))
            return c

        return wide.select(*[field(key, t).alias(name) for name, key, t in STAGING_SPEC], *extra)
    cols, errs = [], []
    for name, key, typ in STAGING_SPEC:
        t = number_type if typ == "number" else typ
        c = F.try_variant_get(v, json_path(key), t)
        cols.append(c.alias(name))
        if t != "variant":
            present = F.try_variant_get(v, json_path(key), "variant")
            bad = present.isNotNull() & ~F.is_variant_null(present) & c.isNull()
            errs.append(F.when(bad, F.lit(name)))
    out_cols = cols + [F.col(c) for c in extra]
    out_cols.append(F.filter(F.array(*errs), lambda x: x.isNotNull()).alias("_errors"))
    return raw.select(*out_cols)


def with_property_keys(stg: DataFrame) -> DataFrame:
    """Staging with the canonical text and surrogate key of both property objects.

    The event-property key is NULL for absent and empty objects.  A staging
    table that has the columns already is returned as it is, so the objects
    are serialised once, when staging is written.
    """
    if set(PROPERTY_COLUMNS) <= set(stg.columns):
        return stg
    texts = stg.withColumns({EVENT_PROPERTIES_TEXT: canonical_json("event_properties"),
                             USER_PROPERTIES_TEXT: canonical_json("user_properties")})
    return texts.withColumns({
        EVENT_PROPERTIES_KEY: F.when(F.col(EVENT_PROPERTIES_TEXT) != "{}", surrogate_key(EVENT_PROPERTIES_TEXT)),
        USER_PROPERTIES_KEY: surrogate_key(USER_PROPERTIES_TEXT)})


def staging_as_text(stg: DataFrame) -> DataFrame:
    """Staging with VARIANT columns rendered as canonical JSON text
    (VARIANT cannot leave Spark through Arrow/pandas or be compared)."""
    known = {"event_properties": EVENT_PROPERTIES_TEXT, "user_properties": USER_PROPERTIES_TEXT}
    rendered = lambda c: F.col(known[c]) if known[c] in stg.columns else F.to_json(F.col(c))
    return stg.select(*[rendered(c).alias(c) if c in VARIANT_COLUMNS else F.col(c)
                        for c in stg.columns if c not in PROPERTY_COLUMNS])

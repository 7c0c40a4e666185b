"""Raw event sources: one VARIANT column ``json_data`` per event.

* :func:`read_raw` scans landed newline-delimited JSON (one file or folder
  per hour) straight into VARIANT with the JSON source's
  ``singleVariantColumn`` option, so no schema inference pass runs and
  unknown keys are kept.
* :func:`raw_from_events` derives the same raw shape from the driver's
  ``events`` table (the adapter of FIXTURES.md §3).  It is a pure
  projection plus a filtered self-union, so it scales with ``events``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.hours import parse_hour

RAW_COL = "json_data"


def read_raw(spark: SparkSession, path: str | list[str], via: str = "text") -> DataFrame:
    """Scan JSONL into ``json_data VARIANT``; a malformed line gives NULL.

    ``via="text"`` (default) reads lines and applies ``try_parse_json``;
    ``via="json"`` uses the JSON source's ``singleVariantColumn`` option.
    Both parse each line once into VARIANT.  The text route is the default
    because in Spark 4.1 the JSON route fails on partitioned folders
    (``hour_key=...``) when a query needs no data column (e.g. a count).
    Partition columns of the folder layout are kept.
    """
    if via == "json":
        return spark.read.format("json").option("singleVariantColumn", RAW_COL).load(path)
    df = spark.read.text(path)
    return df.select(F.try_parse_json("value").alias(RAW_COL), *[c for c in df.columns if c != "value"])


def read_raw_with_hour(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Like :func:`read_raw` plus the landing hour taken from the file name
    (``YYYY-MM-DD_HH.jsonl``) or a ``hour_key=`` partition folder."""
    df = spark.read.text(path).select(F.try_parse_json("value").alias(RAW_COL), "_metadata.file_path")
    name = F.col("file_path")
    flat, folder = r"/(\d{4}-\d{2}-\d{2}_\d{1,2})(?:\.\d+)?\.jsonl$", r"hour_key=(\d{4}-\d{2}-\d{2}_\d{1,2})/"
    key = F.when(name.rlike(flat), F.regexp_extract(name, flat, 1)).otherwise(F.regexp_extract(name, folder, 1))
    return df.select(RAW_COL, parse_hour(key).alias("hour"))


def write_raw_jsonl(raw: DataFrame, path: str, by_hour: bool = True) -> None:
    """Land raw events as JSON lines, one folder per hour (``hour_key=``) or all in one."""
    if not by_hour:
        raw.select(F.to_json(F.col(RAW_COL)).alias("value")).write.mode("overwrite").text(path)
        return
    from eventloom.sources.landing import land_hours, with_hour_key

    land_hours(with_hour_key(raw), path)


# --------------------------------------------------------------------------
# adapter: driver ``events`` table -> raw events (FIXTURES.md §3)
# --------------------------------------------------------------------------

#: Providers that the adapter's users have their mail at, by user id.
ADAPTER_PROVIDERS = ("gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "aol.com", "icloud.com", "mail.com",
                     "protonmail.com", "live.com", "msn.com", "ymail.com", "googlemail.com", "me.com", "mac.com",
                     "comcast.net", "verizon.net")


def adapter_columns(events: DataFrame) -> DataFrame:
    """Flat adapter columns (before JSON assembly), one pass over ``events``.

    Every 20th event is sent again: half of these one second later, half 16
    days later, so that copies lie on both sides of a load's high-water mark.
    NULL users, event times, sessions and IPs, consumer, company and
    non-e-mail users, absent and empty properties and values beyond every
    length limit are derived from the ids; ``k`` comes from the event's own
    ``props``.  Companies, user addresses and property objects grow with the
    data.  The DuckDB oracle states the same columns on its own.
    """
    # spread, since building and parsing JSON is far more work than reading the rows
    tasks = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    eid = F.col("event_id")
    copies = F.when(eid % 40 == 20, F.array(F.lit(0), F.lit(16 * 86400))).when(
        eid % 20 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    b = events.select(
        "event_id", "event_type", "props", F.when(eid % 89 != 3, F.col("user_id")).alias("u"),
        "ts", F.explode(copies).alias("later")).repartition(tasks, "event_id").withColumn(
        "ts", F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("later").cast("decimal(18,6)")))
    u, ts = F.col("u"), F.col("ts")
    hour = F.extract(F.lit("hour"), ts)
    text = lambda *parts: F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])
    off = lambda seconds: ts + F.expr(f"INTERVAL '{seconds}' SECOND")
    provider = F.element_at(F.array(*[F.lit(p) for p in ADAPTER_PROVIDERS]), (F.floor(u / 4) % 16 + 1).cast("int"))
    page = eid % 13
    ep = (F.when(eid % 10 == 1, F.lit(None).cast("string"))
          .otherwise(F.concat(
              F.when(eid % 3 == 0, text('"[Amplitude] Element Text":"el', page, F.when(eid % 223 == 0, F.repeat(F.lit("e"), 600)).otherwise(F.lit("")), '",')).otherwise(F.lit("")),
              text('"[Amplitude] Page Path":"/p', page, '",'),
              F.when(eid % 4 != 2, text('"[Amplitude] Page Title":"Title ', page, F.when(eid % 227 == 0, F.repeat(F.lit("t"), 600)).otherwise(F.lit("")), '",')).otherwise(F.lit("")),
              text('"[Amplitude] Page URL":"https://x.example/p', page, "?s=", F.floor(eid / 7), F.when(eid % 211 == 0, F.repeat(F.lit("u"), 1200)).otherwise(F.lit("")), '",'),
              text('"k":', F.get_json_object("props", "$.k").cast("bigint"), ","),
              text('"referrer":"https://r', eid % 4, ".example/", F.when(eid % 229 == 0, F.repeat(F.lit("r"), 1100)).otherwise(F.lit("")), '",'),
              text('"referring_domain":"r', eid % 4, ".example", F.when(eid % 233 == 0, F.repeat(F.lit("d"), 300)).otherwise(F.lit("")), '"'))))
    ep = F.when(eid % 10 == 0, F.lit("{}")).otherwise(F.concat(F.lit("{"), ep, F.lit("}")))
    # Through a lambda, as Spark then keeps these columns out of whole-stage code: all in one method they
    # pass the 8000 bytecodes beyond which the JVM never compiles a method, and run interpreted.  A column of
    # its own, as what stands inside a lambda is interpreted too.
    event_type = F.transform(F.array("event_type"), lambda x: x)[0]
    null = lambda kind: F.lit(None).cast(kind)
    return b.select(
        text("i-", eid).alias("insert_id"),
        text("u-", eid).alias("uuid"),
        u.alias("amplitude_id"),
        (eid % 5 + 100).alias("app"),
        eid.alias("event_id_raw"),
        F.when(eid % 97 == 0, null("bigint"))
         .otherwise((F.lit(10000) + F.extract(F.lit("day"), ts) * 100 + (hour - hour % 6)).cast("bigint"))
         .alias("session_id_raw"),
        F.when(u % 4 == 1, text("user", u, "@", provider))
         .when(u % 4 == 2, text("User", u, "@Acme", F.floor(u / 8), ".com"))
         .when(u % 4 == 3, text("anon-", u)).alias("user_id"),
        F.when(u.isNotNull(), text("d-", u % 3)).alias("device_id"),
        F.when(u % 3 == 0, F.lit("phone")).when(u % 3 == 1, F.lit("tablet")).alias("device_family"),
        F.when(u % 3 == 0, text("model-", u % 5)).alias("device_type"),
        F.when(u % 5 != 0, text("dma-", u % 7)).alias("dma"),
        F.when(eid % 50 == 7, null("string"))
         .when(eid % 3 == 0, text("10.0.", F.coalesce(u, F.lit(0)) % 37, ".0"))
         .otherwise(text("10.", F.floor(F.coalesce(u, F.lit(0)) / 250) + 1, ".", F.coalesce(u, F.lit(0)) % 250, ".", eid % 3)).alias("ip_address"),
        F.when((eid % 101 != 5) | (eid % 20 == 0), ts).alias("event_time"),
        F.when(eid % 6 != 0, off(-2)).alias("client_event_time"),
        F.when(eid % 6 != 1, off(3)).alias("client_upload_time"),
        F.when(eid % 6 != 2, off(4)).alias("server_received_time"),
        F.when(eid % 6 != 3, off(5)).alias("server_upload_time"),
        F.when(eid % 6 != 4, off(6)).alias("processed_time"),
        event_type.alias("event_type"),
        F.when(u % 6 != 0, text("city", u % 9)).alias("city"),
        F.when(u.isNotNull(), text("r", u % 4)).alias("region"),
        F.lit("GB").alias("country"),
        F.when(u % 2 == 0, F.lit("English")).otherwise(F.lit("French")).alias("language"),
        text("lib/", eid % 2).alias("library"),
        F.when(u % 3 == 0, F.lit("ios")).otherwise(F.lit("android")).alias("os_name"),
        text(eid % 4).alias("os_version"),
        F.when(eid % 2 == 0, F.lit("Web")).otherwise(F.lit("Mobile")).alias("platform"),
        ep.alias("ep"),
        text('{"plan":', F.coalesce(u, F.lit(0)) % 3, "}").alias("up"),
    )


def raw_from_events(events: DataFrame) -> DataFrame:
    """Raw ``json_data`` VARIANT rows built from the ``events`` table.

    Each row becomes the JSON text an export would carry (NULL keys omitted,
    times as ``yyyy-MM-dd HH:mm:ss[.ffffff]``), then ``parse_json`` turns it
    into VARIANT, which is what landing JSONL and reading it back gives.
    """
    a = adapter_columns(events)
    renamed = {"insert_id": "$insert_id", "event_id_raw": "event_id", "session_id_raw": "session_id"}
    times = {n for n, t in a.dtypes if t == "timestamp_ntz"}
    fields = [(F.col(c).cast("string") if c in times else F.col(c)).alias(renamed.get(c, c))
              for c in a.columns if c not in ("ep", "up")]
    # the property objects are JSON text already and go in as they are: no parsing and rendering of their own
    part = lambda key, c: F.when(F.col(c).isNotNull(), F.concat(F.lit(f',"{key}":'), F.col(c))).otherwise(F.lit(""))
    flat = F.to_json(F.struct(*fields))
    # cut by bytes: by characters, each text is counted through twice
    body = F.substring(flat.cast("binary"), F.lit(1), F.octet_length(flat) - 1).cast("string")
    text = F.concat(body, part("event_properties", "ep"), part("user_properties", "up"), F.lit("}"))
    return a.select(F.parse_json(text).alias(RAW_COL))

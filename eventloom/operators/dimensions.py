"""Dimension models: IP addresses, companies, event properties, users."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.functions.keys import email_domain, surrogate_key
from eventloom.operators.latest import latest_per_key
from eventloom.operators.staging import EVENT_PROPERTIES_KEY, EVENT_PROPERTIES_TEXT, with_property_keys

# Consumer e-mail providers whose domain is not a company.
CONSUMER_DOMAINS = (
    "gmail.com", "yahoo.com", "hotmail.com", "outlook.com",
    "aol.com", "icloud.com", "mail.com", "protonmail.com",
    "live.com", "msn.com", "ymail.com", "googlemail.com",
    "me.com", "mac.com", "comcast.net", "verizon.net",
)

# Event-property fields as (output column, JSON key, max chars).
PROPERTY_FIELDS = (
    ("url", "[Amplitude] Page URL", 1000),
    ("referrer", "referrer", 1000),
    ("referring_domain", "referring_domain", 255),
    ("element_text", "[Amplitude] Element Text", 500),
    ("page_title", "[Amplitude] Page Title", 500),
)


def ip_addresses(stg: DataFrame) -> DataFrame:
    """M-IP: one row per non-NULL IP.  Distinct first (map-side partial
    aggregation), key computed once per distinct IP."""
    return (stg.where(F.col("ip_address").isNotNull())
               .select("ip_address").distinct()
               .select(surrogate_key("ip_address").alias("ip_address_id"), "ip_address"))


def user_companies(stg: DataFrame, excluded=CONSUMER_DOMAINS) -> DataFrame:
    """Distinct (company, ip_address) from e-mail user ids, consumer
    providers excluded.  ``ip_address`` may be NULL here."""
    u = F.col("user_id")
    dom = email_domain(u)
    return (stg.where(u.isNotNull() & u.contains("@"))
               .select(dom.alias("company"), "ip_address")
               .where(~F.col("company").isin(*excluded))
               .distinct())


def companies(stg: DataFrame, ips: DataFrame, excluded=CONSUMER_DOMAINS) -> DataFrame:
    """M-CO: one row per (company, IP) where the IP is a known address.

    The inner join with ``ips`` both drops NULL IPs and enforces the FK.
    ``user_companies`` is already distinct on (company, ip) and ``ips`` is
    unique per ip, so the join output needs no second distinct.
    """
    uc = user_companies(stg, excluded)
    return (uc.join(ips.select("ip_address"), "ip_address", "inner")
              .select(surrogate_key("company", "ip_address").alias("company_id"),
                      "company", "ip_address"))


def event_properties(stg: DataFrame, fields=PROPERTY_FIELDS, drop_variant_null: bool = False,
                     properties_as: str = "variant", mode: str = "strict") -> DataFrame:
    """M-EP: one row per distinct property object.

    Objects are compared by canonical JSON text, so key order and spacing do
    not matter; grouping is on the 32-char key with the text carried along
    (partial aggregation collapses repeats before the shuffle).  Fields are
    extracted after the distinct, once per object.
    """
    cond = F.col(EVENT_PROPERTIES_KEY).isNotNull()
    if drop_variant_null:
        cond = cond & ~F.is_variant_null("event_properties")
    # The key alone decides; any text of a key is the same canonical text.  Repeats
    # collapse before the shuffle, so a text travels at most once per task and key.
    distinct = (with_property_keys(stg).where(cond)
                .select(F.col(EVENT_PROPERTIES_KEY).alias("event_properties_id"),
                        F.col(EVENT_PROPERTIES_TEXT).alias("properties_text"))
                .distinct())
    # one parse and one cast of each distinct object to a struct of the
    # wanted fields; a non-object (e.g. JSON null) gives NULL fields, as
    # per-path lookups would.  The parsed object is a column of its own, as each
    # expression that holds the parsing would parse the text again
    parsed = distinct.select("event_properties_id", "properties_text", F.parse_json("properties_text").alias("__v"))
    v = F.col("__v")
    st = "struct<" + ", ".join(f"`{k.replace('`', '``')}`: string" for _, k, _ in fields) + ">"
    if mode == "strict":
        is_object = F.col("properties_text").startswith("{")
        s = F.when(is_object, F.variant_get(v, "$", st))
    else:
        s = F.try_variant_get(v, "$", st)
    kept = (v if properties_as == "variant" else F.col("properties_text")).alias("properties_json")
    wide = parsed.select("event_properties_id", kept, s.alias("__f"))
    extracted = [F.left(F.col("__f").getField(key), F.lit(n)).alias(name) for name, key, n in fields]
    return wide.select("event_properties_id", "properties_json", *extracted)


def latest_user_rows(stg: DataFrame, method: str = "window") -> DataFrame:
    """Latest staging row per amplitude_id (event_time DESC, NULLs first)."""
    base = (stg.where(F.col("amplitude_id").isNotNull())
               .select("amplitude_id", "user_id", "device_id", "ip_address", "event_time", "uuid"))
    return latest_per_key(base, ["amplitude_id"], "event_time", tiebreak=["uuid"], method=method)


def users(stg: DataFrame, ips: DataFrame, comps: DataFrame, attribution: str = "two_lookup",
          method: str = "window") -> DataFrame:
    """M-US: latest state per user plus company attribution.

    A user's company is the company on its IP equal to its own e-mail
    domain, else the alphabetically first company seen on that IP.

    ``fan_out`` joins each user to every company of its IP and re-groups,
    as the warehouse model does; ``two_lookup`` (default) gets the same
    answer from two joins that are unique per key (exact (ip, domain) match
    and per-IP minimum), so no users x companies blow-up on shared IPs and
    no final group-by.
    """
    u = latest_user_rows(stg, method).select(
        "amplitude_id", "user_id", "device_id", "ip_address", "event_time",
        email_domain("user_id").alias("user_email_domain"))
    ui = u.join(ips.select("ip_address", "ip_address_id"), "ip_address", "left")
    if attribution == "fan_out":
        c = comps.select(F.col("ip_address").alias("c_ip"), "company")
        j = ui.join(c, F.col("ip_address") == F.col("c_ip"), "left")
        company = F.coalesce(
            F.max(F.when(F.col("company") == F.col("user_email_domain"), F.col("company"))),
            F.min("company"))
        return (j.groupBy("amplitude_id", "user_id", "device_id", "ip_address_id", "event_time")
                 .agg(company.alias("company"))
                 .select("amplitude_id", "user_id", "device_id", "ip_address_id", "company",
                         F.col("event_time").alias("last_seen")))
    if attribution != "two_lookup":
        raise ValueError(f"unknown attribution {attribution!r}")
    # ip_address_id is non-NULL exactly when the IP is a known address, the
    # condition under which the fan-out form can see companies at all.
    known_ip = F.when(F.col("ip_address_id").isNotNull(), F.col("ip_address"))
    ui = ui.withColumn("known_ip", known_ip)
    exact = comps.select(F.col("ip_address").alias("known_ip"),
                         F.col("company").alias("user_email_domain"),
                         F.col("company").alias("exact_company"))
    first = (comps.groupBy(F.col("ip_address").alias("known_ip"))
                  .agg(F.min("company").alias("first_company")))
    j = (ui.join(exact, ["known_ip", "user_email_domain"], "left")
           .join(first, "known_ip", "left"))
    return j.select("amplitude_id", "user_id", "device_id", "ip_address_id",
                    F.coalesce("exact_company", "first_company").alias("company"),
                    F.col("event_time").alias("last_seen"))

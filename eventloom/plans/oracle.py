"""DuckDB oracle SQL for every registered query.

The driver registers only the base tables as views, so every statement
inlines the adapter (FIXTURES.md §3) and a typed staging CTE, then states
the result in plain SQL.  Nothing is imported from the code under test: key
sentinel, mail providers and checks are stated here again, and the models
are written from their meaning, not after the DataFrame code.
"""

from __future__ import annotations

from eventloom.plans.docs import COLUMN_DOCS

MARK = "timestamp '2024-01-15 03:00:00'"

# Providers whose domain is no company.
PROVIDERS = ["gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "aol.com", "icloud.com", "mail.com", "protonmail.com",
             "live.com", "msn.com", "ymail.com", "googlemail.com", "me.com", "mac.com", "comcast.net", "verizon.net"]
_PROVIDERS = ", ".join(f"'{p}'" for p in PROVIDERS)


def key(*exprs: str) -> str:
    """Surrogate key: md5 of the fields as text, '-' between them, a sentinel for NULL."""
    return "md5(" + " || '-' || ".join(f"coalesce(cast({e} as varchar), '_dbt_utils_surrogate_key_null_')" for e in exprs) + ")"


ADAPTER = f"""
sent as (
  select event_id, event_type, props, case when event_id % 89 <> 3 then user_id end u, ts first_ts,
    unnest(case when event_id % 40 = 20 then [0, 1382400] when event_id % 20 = 0 then [0, 1] else [0] end) later
  from events
),
base as (select *, first_ts + to_seconds(later) ts from sent),
adapter as (
select 'i-' || event_id insert_id, 'u-' || event_id uuid, u amplitude_id, event_id % 5 + 100 app, event_id event_id_raw,
 cast(case when event_id % 97 <> 0
      then 10000 + extract(day from ts) * 100 + (extract(hour from ts) - extract(hour from ts) % 6) end as bigint) session_id_raw,
 case u % 4 when 1 then 'user' || u || '@' || ([{_PROVIDERS}])[u // 4 % 16 + 1]
            when 2 then 'User' || u || '@Acme' || (u // 8) || '.com'
            when 3 then 'anon-' || u end user_id,
 'd-' || (u % 3) device_id,
 case u % 3 when 0 then 'phone' when 1 then 'tablet' end device_family,
 case when u % 3 = 0 then 'model-' || (u % 5) end device_type,
 case when u % 5 <> 0 then 'dma-' || (u % 7) end dma,
 case when event_id % 50 = 7 then null
      when event_id % 3 = 0 then '10.0.' || (coalesce(u, 0) % 37) || '.0'
      else '10.' || (coalesce(u, 0) // 250 + 1) || '.' || (coalesce(u, 0) % 250) || '.' || (event_id % 3) end ip_address,
 case when event_id % 101 <> 5 or event_id % 20 = 0 then ts end event_time,
 case when event_id % 6 <> 0 then ts - interval 2 second end client_event_time,
 case when event_id % 6 <> 1 then ts + interval 3 second end client_upload_time,
 case when event_id % 6 <> 2 then ts + interval 4 second end server_received_time,
 case when event_id % 6 <> 3 then ts + interval 5 second end server_upload_time,
 case when event_id % 6 <> 4 then ts + interval 6 second end processed_time,
 event_type,
 case when u % 6 <> 0 then 'city' || (u % 9) end city,
 'r' || (u % 4) region, 'GB' country,
 case when u % 2 = 0 then 'English' else 'French' end "language",
 'lib/' || (event_id % 2) library,
 case when u % 3 = 0 then 'ios' else 'android' end os_name,
 cast(event_id % 4 as varchar) os_version,
 case when event_id % 2 = 0 then 'Web' else 'Mobile' end platform,
 case event_id % 10 when 0 then '{{}}' when 1 then null else '{{'
   || case when event_id % 3 = 0 then '"[Amplitude] Element Text":"el' || (event_id % 13) || case when event_id % 223 = 0 then repeat('e', 600) else '' end || '",' else '' end
   || '"[Amplitude] Page Path":"/p' || (event_id % 13) || '",'
   || case when event_id % 4 <> 2 then '"[Amplitude] Page Title":"Title ' || (event_id % 13) || case when event_id % 227 = 0 then repeat('t', 600) else '' end || '",' else '' end
   || '"[Amplitude] Page URL":"https://x.example/p' || (event_id % 13) || '?s=' || (event_id // 7) || case when event_id % 211 = 0 then repeat('u', 1200) else '' end || '",'
   || '"k":' || cast(json_extract_string(props, '$.k') as bigint) || ','
   || '"referrer":"https://r' || (event_id % 4) || '.example/' || case when event_id % 229 = 0 then repeat('r', 1100) else '' end || '",'
   || '"referring_domain":"r' || (event_id % 4) || '.example' || case when event_id % 233 = 0 then repeat('d', 300) else '' end || '"'
   || '}}' end ep,
 '{{"plan":' || (coalesce(u, 0) % 3) || '}}' up
from base
)"""

STAGING = """
stg as (select * exclude (ep, up), ep event_properties, up user_properties from adapter)"""

STAGING_COLUMNS = (
    "insert_id amplitude_id app city client_event_time client_upload_time country device_family device_id device_type dma "
    "event_id_raw event_properties event_time event_type ip_address language library os_name os_version platform "
    "processed_time region server_received_time server_upload_time session_id_raw user_id user_properties uuid").split()

_DOMAIN = "lower(split_part(user_id, '@', 2))"
_HAS_MAIL = "position('@' in user_id) > 0"

IPS = f"""
ips as (select {key('ip_address')} ip_address_id, ip_address from stg where ip_address is not null group by ip_address)"""

COMPANIES = f"""
companies as (
select {key('company', 'ip_address')} company_id, company, ip_address
from (select {_DOMAIN} company, ip_address, count(*) seen from stg where {_HAS_MAIL} and ip_address is not null group by all) t
where company not in ({_PROVIDERS})
)"""


def _property(name: str, column: str, most: int) -> str:
    return f"""substr(json_extract_string(properties_json, '$."{name}"'), 1, {most}) {column}"""


EVENT_PROPERTIES = f"""
event_properties as (
select {key('properties_json')} event_properties_id, properties_json,
 {_property('[Amplitude] Page URL', 'url', 1000)}, {_property('referrer', 'referrer', 1000)},
 {_property('referring_domain', 'referring_domain', 255)}, {_property('[Amplitude] Element Text', 'element_text', 500)},
 {_property('[Amplitude] Page Title', 'page_title', 500)}
from (select event_properties properties_json from stg where event_properties <> '{{}}' group by 1) t
)"""

NEWEST = """
newest as (
select distinct on (amplitude_id) amplitude_id, user_id, device_id, ip_address, event_time, uuid
from stg where amplitude_id is not null
order by amplitude_id, event_time desc nulls first, uuid desc nulls last
)"""

USERS = NEWEST + f""",
first_of_ip as (select ip_address, min(company) company from companies group by ip_address),
users as (
select n.amplitude_id, n.user_id, n.device_id, i.ip_address_id, coalesce(own.company, f.company) company, n.event_time last_seen
from newest n
left join ips i using (ip_address)
left join companies own on own.ip_address = n.ip_address and {_HAS_MAIL.replace('user_id', 'n.user_id')}
  and own.company = {_DOMAIN.replace('user_id', 'n.user_id')}
left join first_of_ip f on f.ip_address = n.ip_address
)"""


def sessions_cte(name: str = "sessions", where: str = "true") -> str:
    return f"""
{name} as (
select {key('session_id_raw', 'amplitude_id')} session_id, session_id_raw, amplitude_id, min(user_id) user_id, min(device_id) device_id,
 min(event_time) session_start, max(event_time) session_end, count(*)::bigint event_count,
 string_agg(coalesce(json_extract_string(event_properties, '$."[Amplitude] Page Path"'), ''), ' > '
            order by event_time nulls first, event_id_raw, uuid) user_journey,
 {key("coalesce(min(city), '')", "coalesce(min(region), '')", "coalesce(min(country), '')")} location_id
from stg where session_id_raw is not null and {where}
group by session_id_raw, amplitude_id
)"""


EVENTS = f"""
last_copy as (select distinct on (uuid) * from stg order by uuid, event_time desc nulls first),
int_events as (
select {key('e.uuid')} event_id, e.event_id_raw, {key('e.session_id_raw', 'e.amplitude_id')} session_id,
 e.session_id_raw, e.amplitude_id, {key('e.ip_address')} ip_address_id, e.event_time, e.event_type,
 {key('e.user_properties')} user_properties_id,
 case when e.event_properties <> '{{}}' then {key('e.event_properties')} end event_properties_id,
 (select u.company from users u where u.amplitude_id = e.amplitude_id) company_name, e.uuid
from last_copy e
)"""


def with_ctes(*ctes: str, body: str) -> str:
    return "with " + ",".join(ctes) + "\n" + body


PRE = (ADAPTER, STAGING)
DIMS = (*PRE, IPS, COMPANIES, USERS)

ORACLE: dict[str, str] = {
    "stg_events": with_ctes(*PRE, body="select " + ", ".join(f'"{c}"' for c in STAGING_COLUMNS) + " from stg"),
    "ip_addresses": with_ctes(*PRE, IPS, body="select * from ips"),
    "companies": with_ctes(*PRE, COMPANIES, body="select * from companies"),
    "event_properties": with_ctes(*PRE, EVENT_PROPERTIES, body="select * from event_properties"),
    "users": with_ctes(*DIMS, body="select * from users"),
    "sessions": with_ctes(*PRE, sessions_cte(), body="select * from sessions"),
    "events": with_ctes(*DIMS, EVENTS, body="select * from int_events"),
}
ORACLE["users_fan_out"] = ORACLE["users_two_lookup"] = ORACLE["users"]


# --------------------------------------------------------------------------
# data quality
# --------------------------------------------------------------------------

# The declared checks, by relation.
NOT_NULL = {
    "raw_events": "json_data", "stg_events": "uuid event_time event_type",
    "events": "event_id session_id amplitude_id event_time event_type", "users": "amplitude_id last_seen",
    "sessions": "session_id session_id_raw amplitude_id session_start session_end event_count location_id",
    "ip_addresses": "ip_address_id ip_address", "event_properties": "event_properties_id properties_json",
    "companies": "company_id company ip_address",
}
UNIQUE = {"events": "event_id", "users": "amplitude_id", "sessions": "session_id", "ip_addresses": "ip_address_id ip_address",
          "event_properties": "event_properties_id", "companies": "company_id"}
RELATIONSHIPS = [
    ("events", "session_id", "sessions", "session_id"), ("events", "amplitude_id", "users", "amplitude_id"),
    ("events", "ip_address_id", "ip_addresses", "ip_address_id"),
    ("events", "event_properties_id", "event_properties", "event_properties_id"),
    ("users", "ip_address_id", "ip_addresses", "ip_address_id"), ("sessions", "amplitude_id", "users", "amplitude_id"),
]
RELATION = {"raw_events": "(select to_json(a) json_data from adapter a)", "stg_events": "stg", "events": "int_events", "ip_addresses": "ips"}


def dq_sql(*kinds: str) -> str:
    rows = []
    if "not_null" in kinds:
        rows += [(m, c, "not_null", None, f"select count(*) - count({c}) from {RELATION.get(m, m)} t")
                 for m, cs in NOT_NULL.items() for c in cs.split()]
    if "unique" in kinds:
        rows += [(m, c, "unique", None, f"select count(*) from (select {c} from {RELATION.get(m, m)} t where {c} is not null group by 1 having count(*) > 1) g")
                 for m, cs in UNIQUE.items() for c in cs.split()]
    if "relationships" in kinds:
        rows += [(m, c, "relationships", f"{p}.{f}",
                  f"select count(*) from {RELATION.get(m, m)} t where {c} is not null and {c} not in (select {f} from {RELATION.get(p, p)} where {f} is not null)")
                 for m, c, p, f in RELATIONSHIPS]
    body = "\nunion all\n".join(
        f"""select '{m}' model, '{c}' "column", '{k}' "check", {f"'{r}'" if r else 'null::varchar'} ref, ({q})::bigint failures""" for m, c, k, r, q in rows)
    return with_ctes(*DIMS, EVENT_PROPERTIES, sessions_cte(), EVENTS, body=(
        f"""select model, "column", "check", ref, failures, if(failures = 0, 'pass', 'fail') status from (\n{body}\n) r"""))


ORACLE.update({
    "dq_not_null": dq_sql("not_null"),
    "dq_unique": dq_sql("unique"),
    "dq_relationships": dq_sql("relationships"),
    "dq_suite": dq_sql("not_null", "unique", "relationships"),
})


# --------------------------------------------------------------------------
# hour-coverage ledger and scalar functions
# --------------------------------------------------------------------------

LEDGER = """
present as (select event_type source, date_trunc('hour', ts) as hour from events group by all),
bounds as (select min(hour) lo, max(hour) hi from present),
required as (select source, unnest(generate_series(lo, hi, interval 1 hour)) as hour from (select distinct source from present) s, bounds),
missing as (select * from required except select * from present),
isl as (select source, hour,
               hour - to_hours(cast(row_number() over (partition by source order by hour) as bigint)) grp
        from missing)"""


def batches_sql(cap: int | None) -> str:
    chunk = "0" if cap is None else f"(row_number() over (partition by source, grp order by hour) - 1) // {cap}"
    return with_ctes(LEDGER, f"""
chunks as (select source, hour, grp, {chunk} chunk from isl)""", body="""
select source, min(hour) batch_start, max(hour) batch_end, cast(count(*) as bigint) n_hours,
       strftime(min(hour), '%Y%m%dT%H') start_key, strftime(max(hour), '%Y%m%dT%H') end_key
from chunks group by source, grp, chunk""")


LOCAL_REMOTE = f"""
loc as (select distinct event_type source, date_trunc('hour', event_time) as hour from stg where event_time is not null),
rem as (select distinct event_type source, date_trunc('hour', event_time) as hour from stg where event_time <= {MARK})"""

ORACLE.update({
    "hours_required": with_ctes(LEDGER, body="select source, hour from required"),
    "hours_missing": with_ctes(LEDGER, body="select source, hour from missing"),
    "hour_batches": batches_sql(None),
    "hour_batches_capped": batches_sql(1),
    "resume_points": with_ctes(LEDGER, body="""
select source, resume_hour, strftime(resume_hour, '%Y%m%dT%H') resume_key from (
  select r.source, coalesce(min(m.hour), (select hi + interval 1 hour from bounds)) resume_hour
  from required r left join missing m on m.source = r.source and m.hour = r.hour group by r.source) t"""),
    "hours_publishable": with_ctes(*PRE, LOCAL_REMOTE, body="select * from loc except select * from rem"),
    "hours_discardable": with_ctes(*PRE, LOCAL_REMOTE, body="select * from loc intersect select * from rem"),
    "coverage_report": with_ctes(LEDGER, body="""
select r.source, count(*)::bigint required_hours, (count(*) - count(i.hour))::bigint present_hours,
       count(i.hour)::bigint missing_hours, count(distinct i.grp)::bigint batches
from required r left join isl i on i.source = r.source and i.hour = r.hour group by r.source"""),
    "hour_key_roundtrip": with_ctes(LEDGER, body="""
select distinct hour as hour, strftime(hour, '%Y-%m-%d_%H') file_key, strftime(hour, '%Y%m%dT%H') api_key,
       hour parsed_file, hour parsed_api, hour parsed_space, hour parsed_short
from present"""),
    "archive_names_to_hours": """
select distinct case event_id % 3
    when 0 then concat(cast(user_id as varchar), '/', cast(user_id as varchar), '_', strftime(ts, '%Y-%m-%d'), '_',
                       cast(hour(ts) as varchar), '#', cast(event_id as varchar), '.json.gz')
    when 1 then concat(strftime(ts, '%Y-%m-%d'), '_', cast(hour(ts) as varchar), '.json.gz')
    else concat(cast(user_id as varchar), '_', strftime(ts, '%Y-%m-%d'), '_', strftime(ts, '%H'), '#x.json.gz')
  end member_name,
  strftime(ts, '%Y-%m-%d_%H') hour_key
from events""",
    "default_window": """
select event_id, date_trunc('hour', ts - interval 12 hour) - interval 1 day window_start,
       date_trunc('hour', ts - interval 12 hour) window_end, cast(25 as bigint) n_hours
from events""",
    "surrogate_keys": with_ctes(*PRE, body=f"""
select uuid, event_time, {key('uuid')} k_uuid, {key('session_id_raw', 'amplitude_id')} k_session,
       {key('city', 'region', 'country')} k_location, {key('ip_address')} k_ip,
       {key('device_type', 'uuid')} k_null_first
from stg"""),
    "consumer_domain_filter": with_ctes(*PRE, body=f"""
select user_id, {_DOMAIN} email_domain, {_DOMAIN} not in ({_PROVIDERS}) is_company
from (select distinct user_id from stg where {_HAS_MAIL}) u"""),
    "latest_per_key_maxby": with_ctes(*PRE, NEWEST, body="select * from newest"),
})
ORACLE.update({
    "hours_missing_stored": ORACLE["hours_missing"],
    "coverage_report_stored": ORACLE["coverage_report"],
    "hours_per_source": with_ctes(LEDGER, body="select source, count(*) n_hours from present group by source"),
})
ORACLE["latest_per_key_window"] = ORACLE["latest_per_key_maxby"]
ORACLE["events_maxby"] = ORACLE["events"]


# --------------------------------------------------------------------------
# incremental loads: whatever the steps, the tables end up as the one-shot
# models over the same rows; only the warehouse's "overwrite" differs
# --------------------------------------------------------------------------

OVERWRITTEN = (
    sessions_cte("seed_sessions", f"(event_time <= {MARK} or event_time is null)"),
    sessions_cte("inc_sessions", "event_time > (select max(session_end) from seed_sessions)"),
)


def _overwritten(stored: str) -> str:
    return with_ctes(*PRE, *OVERWRITTEN, body=f"""
select {stored} from seed_sessions s where not exists (select 1 from inc_sessions i where i.session_id = s.session_id)
union all by name
select * from inc_sessions""")


for _name in ("events_incremental", "events_lookback", "events_incremental_table", "events_upsert_null_time",
              "events_moved_keys", "events_table_version"):
    ORACLE[_name] = ORACLE["events"]
for _name in ("sessions_incremental_table", "sessions_lookback", "sessions_incremental_merge_whole",
              "sessions_merge_whole_late_untimed", "sessions_incremental_merge", "sessions_merge_null_user"):
    ORACLE[_name] = ORACLE["sessions"]
ORACLE.update({
    "sessions_incremental_overwrite": _overwritten("*"),
    "schema_sync": _overwritten("* replace (null::varchar as location_id)"),
})


# --------------------------------------------------------------------------
# the build runner
# --------------------------------------------------------------------------

_MODELS = {"ip_addresses": "ips", "companies": "companies", "users": "users", "event_properties": "event_properties",
           "sessions": "sessions", "events": "int_events"}
_ALL_MODELS = (*DIMS, EVENT_PROPERTIES, sessions_cte(), EVENTS)
_SESSION_COLUMNS = ("session_id session_id_raw amplitude_id user_id device_id session_start session_end event_count "
                    "user_journey location_id").split()


def _text(value: str | None) -> str:
    return "null::varchar" if value is None else "'" + value.replace("'", "''") + "'"


for _name in ("users", "companies", "ip_addresses", "event_properties"):
    ORACLE[f"{_name}_maintained"] = ORACLE[_name]
ORACLE.update({
    "dq_suite_incremental": ORACLE["dq_suite"],
    "run_from_stored_parents": ORACLE["users"],
    "run_with_parents": ORACLE["users"],
    "run_full_refresh": ORACLE["events"],
    "run_layer": with_ctes(*_ALL_MODELS, body=" union all ".join(
        f"select '{m}' model, count(*) n_rows from {t}" for m, t in _MODELS.items())),
    "published_views": with_ctes(*DIMS, sessions_cte(), EVENTS, body="""
select e.company_name, count(*) n_events, count(distinct s.session_id) n_sessions, max(s.event_count) longest
from int_events e left join sessions s on s.session_id = e.session_id group by e.company_name"""),
    "described_columns": with_ctes(*PRE, sessions_cte(), body=" union all ".join(
        f"""select '{c}' "column", {_text(COLUMN_DOCS.get(c))} "comment", count({c}) n_known from sessions""" for c in _SESSION_COLUMNS)),
})


# --------------------------------------------------------------------------
# landing, archives, streaming
# --------------------------------------------------------------------------

_LANDED = with_ctes(*PRE, body="select uuid, event_time, date_trunc('hour', event_time) as hour from stg")
_KEYED = with_ctes(*PRE, body="select uuid, event_time, strftime(event_time, '%Y-%m-%d_%H') hour_key from stg")
_ONE_COPY = "select uuid, amplitude_id, event_type, event_id_raw{} from stg group by all"

ORACLE.update({
    "raw_landed_hours": _LANDED,
    "flat_hour_files": _LANDED,
    "land_new_hours": _KEYED,
    "raw_table_staging": ORACLE["stg_events"],
    "raw_table_sessions": ORACLE["sessions"],
    "raw_table_landed_again": _KEYED,
    "archive_unpack": _KEYED,
    # either copy of a uuid may be the one kept; these columns agree on both
    "stream_dedupe": with_ctes(*PRE, body=_ONE_COPY.format("")),
    "stream_dedupe_late": with_ctes(*PRE, body=_ONE_COPY.format(f", coalesce(max(event_time) < {MARK}, false) late")),
    "stream_events_upsert": ORACLE["events"],
    "stream_two_checkpoints": ORACLE["events"],
    "stream_sessions_upsert": ORACLE["sessions"],
    "stream_sessions_out_of_order": ORACLE["sessions"],
})

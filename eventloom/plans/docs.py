"""Descriptions of models and columns.

Column descriptions are attached to written models (``metadata['comment']``):
Parquet keeps Spark field metadata in its footer, so they travel with the
tables and show in ``DESCRIBE`` / ``schema.fields``.  Model descriptions
become the comments of catalog tables (:func:`eventloom.plans.dag.publish`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame

MODEL_DOCS: dict[str, str] = {
    "stg_events": "Raw events parsed once into typed columns; one row per raw row, duplicates kept.",
    "ip_addresses": "Distinct non-NULL IP addresses with their key.",
    "companies": "Company per (e-mail domain, IP) pair; consumer mail providers excluded.",
    "event_properties": "Distinct event-property objects with common fields extracted.",
    "users": "Latest known state per user with company attribution.",
    "sessions": "One row per (session id, user) with timing, event count and page journey.",
    "events": "Deduplicated event fact with keys to all dimensions and the user's company.",
}

COLUMN_DOCS: dict[str, str] = {
    "event_id": "md5 key of the event uuid.",
    "event_id_raw": "Event id as sent by the tracking source.",
    "session_id": "md5 key of (session_id_raw, amplitude_id).",
    "session_id_raw": "Session id as sent by the tracking source (NULL when none).",
    "amplitude_id": "Tracking-source user id.",
    "ip_address_id": "md5 key of the IP address.",
    "ip_address": "Client IP address.",
    "event_time": "Event time, UTC, without time zone.",
    "event_type": "Event name.",
    "user_properties_id": "md5 key of the canonical user-properties JSON.",
    "event_properties_id": "md5 key of the canonical event-properties JSON; NULL when absent or empty.",
    "company_name": "Company of the user when the event was loaded.",
    "uuid": "Event uuid; duplicates are removed in the event fact.",
    "insert_id": "Deduplication id set by the sending library.",
    "app": "Project number of the sending application.",
    "city": "City of the client.",
    "client_event_time": "Event time by the client's clock.",
    "client_upload_time": "Time the client sent the event.",
    "country": "Country of the client.",
    "device_family": "Device family.",
    "device_type": "Device model.",
    "dma": "Designated market area of the client.",
    "event_properties": "Properties of the event, as sent.",
    "language": "Language of the client.",
    "library": "Sending library and its version.",
    "os_name": "Operating system.",
    "os_version": "Version of the operating system.",
    "platform": "Platform of the client.",
    "processed_time": "Time the event was processed by the tracking source.",
    "region": "Region of the client.",
    "server_received_time": "Time the event reached the tracking source.",
    "server_upload_time": "Time the event was stored by the tracking source.",
    "user_properties": "Properties of the user, as sent.",
    "event_properties_text": "Canonical JSON text of the event properties.",
    "event_properties_key": "md5 key of that text; NULL when absent or empty.",
    "user_properties_text": "Canonical JSON text of the user properties.",
    "user_properties_key": "md5 key of that text.",
    "event_date": "Date of the event time (partition).",
    "session_date": "Date of the session start (partition).",
    "user_id": "Application user id (often an e-mail address).",
    "device_id": "Device id.",
    "company": "Lower-cased e-mail domain used as company name.",
    "company_id": "md5 key of (company, ip_address).",
    "last_seen": "Time of the user's latest event.",
    "session_start": "Time of the session's first event.",
    "session_end": "Time of the session's last event.",
    "event_count": "Events in the session (staging rows, duplicates included).",
    "user_journey": "Page paths of the session's events in time order, joined by ' > '.",
    "location_id": "md5 key of (city, region, country), empty strings for NULLs.",
    "properties_json": "The property object.",
    "url": "Page URL, first 1000 characters.",
    "referrer": "Referrer, first 1000 characters.",
    "referring_domain": "Referring domain, first 255 characters.",
    "element_text": "Clicked element text, first 500 characters.",
    "page_title": "Page title, first 500 characters.",
}


def with_comments(df: DataFrame, docs: dict[str, str] = COLUMN_DOCS) -> DataFrame:
    """Attach ``comment`` metadata to every documented column (no data change)."""
    for c in df.columns:
        if c in docs:
            df = df.withMetadata(c, {"comment": docs[c]})
    return df

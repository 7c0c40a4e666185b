from eventloom.streaming.stream import (  # noqa: F401
    dedupe_stream,
    start_dedupe,
    start_events_upsert,
    start_sessions_upsert,
    stream_raw,
    stream_staging,
)

from eventloom.sources.raw import (  # noqa: F401
    raw_from_events,
    read_raw,
    read_raw_with_hour,
    write_raw_jsonl,
)

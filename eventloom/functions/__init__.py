from eventloom.functions.keys import (  # noqa: F401
    NULL_SENTINEL,
    canonical_json,
    email_domain,
    surrogate_key,
)
from eventloom.functions.hours import (  # noqa: F401
    default_window,
    format_hour,
    hour_key_from_name,
    hour_range,
    ntz_lit,
    parse_hour,
)

from eventloom.operators.staging import parse_events, staging_as_text, STAGING_SPEC  # noqa: F401
from eventloom.operators.dimensions import (  # noqa: F401
    CONSUMER_DOMAINS, PROPERTY_FIELDS, companies, event_properties, ip_addresses, users,
)
from eventloom.operators.facts import events, sessions  # noqa: F401
from eventloom.operators.latest import latest_per_key  # noqa: F401

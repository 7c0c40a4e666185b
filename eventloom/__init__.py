"""eventloom: a Spark-native product-analytics event pipeline.

Raw semi-structured events (one VARIANT column) are parsed once into typed
staging columns, then shaped into an event fact plus session, user,
company, IP-address and event-property dimensions.  Around that sit
incremental upserts, declarative data-quality checks, an hour-coverage
ledger and Structured Streaming variants of the loads.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
Spark SQL expressions so Catalyst plans it and the work runs distributed.
"""

__version__ = "0.1.0"

"""changefeed: change-event feeds on Spark.

Feed lines are framed, validated and filtered by domain, parsed against a
fixed schema, flattened into typed rows, appended to a table by a
Structured Streaming query, and summarised per domain in batch.  Every
step is a DataFrame -> DataFrame function built from JVM-side Spark
expressions, so Catalyst plans it and it scales with the cluster.
"""

from changefeed.schema import EVENT_SCHEMA, FLAT_COLUMNS, FLAT_SCHEMA, KEYED_SCHEMA, SUMMARY_SCHEMA
from changefeed.session import build_session, shared_dir

__all__ = [
    "EVENT_SCHEMA",
    "FLAT_COLUMNS",
    "FLAT_SCHEMA",
    "KEYED_SCHEMA",
    "SUMMARY_SCHEMA",
    "build_session",
    "shared_dir",
]

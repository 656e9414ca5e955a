"""Render the ``events`` table as an event-feed text stream.

Each event becomes one feed line, so the feed grows with the table.  Some
lines are deliberately not plain events -- keep-alives, a missing space
after the prefix, truncated JSON, a non-object payload, a null ``meta``, a
missing ``meta`` -- so every ingest rule sees real traffic.  The object
fields are built with ``to_json`` over a ``named_struct``; nothing leaves
the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changefeed.operators.evaluation import once

# Which event ids become which kind of line (first rule wins).
#   event_id % 97 = 0  -> ":ok" keep-alive
#   event_id % 89 = 0  -> "data:" + object, no space
#   event_id % 83 = 0  -> "data: " + first 20 characters of the object
#   event_id % 79 = 0  -> "data: [1]"
#   event_id % 73 = 0  -> object with "meta":null
#   event_id % 71 = 0  -> object without meta
#   otherwise          -> "data: " + object
# Object fields: meta.domain = server_name = event_type + ".example.org";
# namespace = user_id % 16; title = "Page " + user_id; comment = props;
# timestamp = epoch seconds of ts read as UTC; user = "user" + user_id;
# bot = event_id % 5 = 0; length.new = floor(value);
# length.old = null when event_id % 7 = 0, else event_id % 1000.
KEEPALIVE_MOD = 97
NO_SPACE_MOD = 89
TRUNCATED_MOD = 83
TRUNCATED_CHARS = 20
ARRAY_MOD = 79
META_NULL_MOD = 73
NO_META_MOD = 71
DOMAIN_SUFFIX = ".example.org"


def _epoch_seconds(ts: Column) -> Column:
    # zone-free: seconds between two wall clocks
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            ts.cast("timestamp_ntz"))


def _object_without_meta() -> Column:
    eid = F.col("event_id")
    uid = F.col("user_id")
    host = F.concat(F.col("event_type"), F.lit(DOMAIN_SUFFIX))
    length = F.struct(
        F.floor("value").cast("int").alias("new"),
        F.when(eid % 7 != 0, (eid % 1000).cast("int")).alias("old"),
    )
    return F.to_json(
        F.struct(
            eid.alias("id"),
            F.col("event_type").alias("type"),
            (uid % 16).cast("int").alias("namespace"),
            F.concat(F.lit("Page "), uid.cast("string")).alias("title"),
            F.col("props").alias("comment"),
            _epoch_seconds(F.col("ts")).alias("timestamp"),
            F.concat(F.lit("user"), uid.cast("string")).alias("user"),
            (eid % 5 == 0).alias("bot"),
            host.alias("server_name"),
            length.alias("length"),
        )
    )


def render_feed(events: DataFrame, keep_ts: bool = False, keep_id: bool = False) -> DataFrame:
    """``events`` -> feed lines ``value`` (plus ``ts`` when ``keep_ts``, and
    ``event_id`` when ``keep_id``)."""
    eid = F.col("event_id")
    rest = F.col("_rest")  # '{"id":...}' without meta
    body = F.substr(rest, F.lit(2))  # '"id":...}'
    meta = F.to_json(F.struct(F.concat(F.col("event_type"), F.lit(DOMAIN_SUFFIX)).alias("domain")))
    full = F.concat(F.lit('{"meta":'), meta, F.lit(","), body)
    line = (
        F.when(eid % KEEPALIVE_MOD == 0, F.lit(":ok"))
        .when(eid % NO_SPACE_MOD == 0, F.concat(F.lit("data:"), full))
        .when(eid % TRUNCATED_MOD == 0, F.concat(F.lit("data: "), F.substr(full, F.lit(1), F.lit(TRUNCATED_CHARS))))
        .when(eid % ARRAY_MOD == 0, F.lit("data: [1]"))
        .when(eid % META_NULL_MOD == 0, F.concat(F.lit('data: {"meta":null,'), body))
        .when(eid % NO_META_MOD == 0, F.concat(F.lit("data: "), rest))
        .otherwise(F.concat(F.lit("data: "), full))
    )
    rendered = events.select("event_id", "event_type", "ts", _object_without_meta().alias("_rest"))
    # Render each line once, even when a later filter reads it.
    rendered = once(rendered, line, "value")
    return rendered.select("value", *(["ts"] if keep_ts else []), *(["event_id"] if keep_id else []))

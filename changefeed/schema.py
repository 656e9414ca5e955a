"""Schemas of the change-event data model.

The event schema is fixed and explicit: the parser never infers one, so a
stream or a file scan sees the same types on every micro-batch.
"""

from pyspark.sql.types import (
    BinaryType,
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Names, types and order are the input contract.
# Change event as it arrives (all fields nullable).  ``namespace`` is parsed
# but not carried into the flat row.
EVENT_SCHEMA = StructType(
    [
        StructField("meta", StructType([StructField("domain", StringType())])),
        StructField("id", LongType()),
        StructField("type", StringType()),
        StructField("namespace", IntegerType()),
        StructField("title", StringType()),
        StructField("comment", StringType()),
        StructField("timestamp", LongType()),
        StructField("user", StringType()),
        StructField("bot", BooleanType()),
        StructField("server_name", StringType()),
        StructField(
            "length",
            StructType([StructField("new", IntegerType()), StructField("old", IntegerType())]),
        ),
    ]
)

# The flat change row, in output order.
FLAT_SCHEMA = StructType(
    [
        StructField("event_id", LongType()),
        StructField("event_type", StringType()),
        StructField("page_title", StringType()),
        StructField("comment", StringType()),
        StructField("event_timestamp", StringType()),
        StructField("user", StringType()),
        StructField("bot", BooleanType()),
        StructField("domain", StringType()),
        StructField("server_name", StringType()),
        StructField("new_length", IntegerType()),
        StructField("old_length", IntegerType()),
    ]
)
FLAT_COLUMNS = [f.name for f in FLAT_SCHEMA.fields]

# The part of an event that a per-domain summary reads.
DOMAIN_SCHEMA = StructType([StructField("meta", StructType([StructField("domain", StringType())]))])

# Per-domain summary row.
SUMMARY_SCHEMA = StructType(
    [StructField("domain", StringType()), StructField("edit_count", LongType(), False)]
)

# Keyed stream record: the key/value layout of a message-bus sink.
KEYED_SCHEMA = StructType([StructField("key", StringType()), StructField("value", BinaryType())])

# Raw feed lines as a text source delivers them.
LINES_SCHEMA = StructType([StructField("value", StringType())])

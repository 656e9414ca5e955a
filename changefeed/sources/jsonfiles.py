"""JSON-text collections read with the fixed event schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changefeed.functions import JSON_READ_OPTIONS
from changefeed.schema import EVENT_SCHEMA
from changefeed.sources.feed import MAX_FILE_AGE


def json_events(spark: SparkSession, path: str, streaming: bool = False,
                max_bytes_per_trigger: str | None = None) -> DataFrame:
    """One row per JSON object in the files under ``path`` (JSON Lines),
    parsed with the fixed event schema: no inference pass over the data.

    Same permissive rules as :func:`changefeed.operators.parse`, except that
    a blank line yields no row and a top-level array yields one row per
    element.
    """
    if not streaming:
        return spark.read.schema(EVENT_SCHEMA).options(**JSON_READ_OPTIONS).json(path)
    reader = spark.readStream.schema(EVENT_SCHEMA).options(maxFileAge=MAX_FILE_AGE, **JSON_READ_OPTIONS)
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.json(path)

"""Keyed record streams (key STRING, value BINARY)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.schema import KEYED_SCHEMA
from changefeed.sources.feed import MAX_FILE_AGE


def _bus_columns(df: DataFrame) -> DataFrame:
    return df.select(F.col("key").cast("string").alias("key"), F.col("value").cast("binary").alias("value"))


def record_stream(spark: SparkSession, fmt: str = "parquet", path: str | None = None,
                  options: dict[str, str] | None = None, starting: str = "latest",
                  max_files_per_trigger: int | None = None,
                  max_bytes_per_trigger: str | None = None) -> DataFrame:
    """Streaming keyed records.

    ``fmt="kafka"``: a message-bus topic (connector jar required);
    ``starting`` becomes ``startingOffsets`` and applies only when the query
    has no checkpoint yet, so a first run starts at the tip and later runs
    resume where they stopped.  Any file format: the files under ``path``
    with the fixed keyed schema; a file source has no tip and reads what is
    already there on its first run.  The per-trigger caps (files or bytes)
    bound the size of each micro-batch when a backlog is drained; for a
    topic, pass ``maxOffsetsPerTrigger`` in ``options`` instead.
    """
    options = dict(options or {})
    reader = spark.readStream.format(fmt)
    if fmt == "kafka":
        options.setdefault("startingOffsets", starting)
        return _bus_columns(reader.options(**options).load())
    options.setdefault("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger:
        options.setdefault("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        options.setdefault("maxBytesPerTrigger", max_bytes_per_trigger)
    reader = reader.schema(KEYED_SCHEMA).options(**options)
    return _bus_columns(reader.load(path) if path else reader.load())


def read_records(spark: SparkSession, fmt: str = "parquet", path: str | None = None,
                 options: dict[str, str] | None = None) -> DataFrame:
    """The same records as a batch DataFrame (a backfill or a replay)."""
    options = dict(options or {})
    reader = spark.read.format(fmt).options(**options)
    if fmt == "kafka":
        return _bus_columns(reader.load())
    reader = reader.schema(KEYED_SCHEMA)
    return _bus_columns(reader.load(path) if path else reader.load())

"""Landed event-feed lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A file source passes over files older than the newest by more than this.
#: Far beyond any real delay: a late file must not be lost.
MAX_FILE_AGE = "3650d"
#: Columns that place a line in the feed, in order, with their names in the file metadata.
POSITION = {"file_time": "file_modification_time", "file": "file_path", "block": "file_block_start"}


def feed_lines(spark: SparkSession, path: str, streaming: bool = False,
               max_files_per_trigger: int | None = None,
               max_bytes_per_trigger: str | None = None,
               options: dict[str, str] | None = None, positions: bool = False) -> DataFrame:
    """One row per line (``value STRING``) of the text files under ``path``.

    Batch: a split-parallel text scan.  Streaming: a file source that
    picks up files as they land; the per-trigger caps bound each
    micro-batch when a backlog (or ``availableNow``) is drained.  Lines end
    at ``\\n``, ``\\r\\n`` or ``\\r``.  ``options`` pass through to the
    reader, e.g. ``{"cleanSource": "archive", "sourceArchiveDir": ...}`` so a
    long-running stream's landing folder (and its listing) stays small.
    ``positions`` adds where a line comes from (:data:`POSITION`).
    """
    where = ["value", *(F.col(f"_metadata.{m}").alias(c) for c, m in POSITION.items())] if positions else ["value"]
    if not streaming:
        return spark.read.options(**(options or {})).text(path).select(*where)
    reader = spark.readStream.options(**{"maxFileAge": MAX_FILE_AGE, **(options or {})})
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if max_bytes_per_trigger:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.text(path).select(*where)

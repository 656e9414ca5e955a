"""Sinks: keyed records, streaming append, summary overwrite."""

from changefeed.sinks.outputs import BatchReport, Output, append_outputs, read_batches, read_metrics
from changefeed.sinks.publish import current, publish, runs
from changefeed.sinks.tables import append_batches, append_stream, overwrite, write_records

__all__ = [
    "BatchReport",
    "Output",
    "append_batches",
    "append_outputs",
    "append_stream",
    "current",
    "overwrite",
    "publish",
    "read_batches",
    "read_metrics",
    "runs",
    "write_records",
]

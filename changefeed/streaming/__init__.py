"""Structured Streaming helpers: triggers, bounded runs, metrics, preview."""

from changefeed.streaming.metrics import (
    BatchRowsListener,
    batch_rows,
    observe_rows,
    preview,
    preview_stream,
)
from changefeed.streaming.triggers import (
    apply_trigger,
    batch_bytes,
    drain,
    run_all,
    run_bounded,
    start_at_tip,
    stop_at_batch_end,
)

__all__ = [
    "BatchRowsListener",
    "apply_trigger",
    "batch_bytes",
    "batch_rows",
    "drain",
    "observe_rows",
    "preview",
    "preview_stream",
    "run_all",
    "run_bounded",
    "start_at_tip",
    "stop_at_batch_end",
]

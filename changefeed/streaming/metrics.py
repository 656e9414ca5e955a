"""Per-batch metrics and preview."""

from __future__ import annotations

import time
from collections import deque

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


def observe_rows(df: DataFrame, name: str = "changes") -> DataFrame:
    """Count the rows that pass this point, per batch, as a named metric.

    The count is gathered by the same job that writes the batch (no extra
    action), and is read back from the query progress.
    """
    return df.observe(name, F.count(F.lit(1)).alias("n"))


def batch_rows(query: StreamingQuery, name: str = "changes") -> list[tuple[int, int]]:
    """``(batch_id, rows)`` for the batches in the query's recent progress,
    of which Spark keeps the last 100; :class:`BatchRowsListener` has totals."""
    out = []
    for progress in query.recentProgress:
        metric = (progress.observedMetrics or {}).get(name)
        if metric is not None:
            out.append((progress.batchId, int(metric["n"])))
    return out


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """A bounded sample of at most ``n`` rows (opt-in)."""
    return df.limit(n)


class BatchRowsListener(StreamingQueryListener):
    """Receives every batch's observed row count, for queries that run for
    days (``recentProgress`` keeps only the last updates).

    ``callback(query_name, batch_id, rows)`` runs on the driver for each
    progress event that carries the metric.  ``totals`` has the rows and
    batches so far by query id, however many batches there were; ``rows``
    keeps the last ``keep`` batches only.
    """

    def __init__(self, name: str = "changes", callback=None, keep: int = 1000):
        self.name = name
        self.rows: deque[tuple[str | None, int, int]] = deque(maxlen=keep)
        self.totals: dict[str, tuple[int, int]] = {}
        self.ended: set[str] = set()
        self._callback = callback or (lambda q, b, n: self.rows.append((q, b, n)))

    def total(self, query: StreamingQuery, timeout: float = 60) -> int:
        """Rows of a query that has ended, once its last event has come (the
        events arrive in order but after the query's end)."""
        deadline = time.monotonic() + timeout
        while str(query.id) not in self.ended:
            if time.monotonic() > deadline:
                raise TimeoutError("the query's last event did not come")
            time.sleep(0.05)
        return self.totals.get(str(query.id), (0, 0))[0]

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        metric = (progress.observedMetrics or {}).get(self.name)
        if metric is not None:
            rows, batches = self.totals.get(str(progress.id), (0, 0))
            self.totals[str(progress.id)] = (rows + int(metric["n"]), batches + 1)
            self._callback(progress.name, progress.batchId, int(metric["n"]))

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        self.ended.add(str(event.id))


def preview_stream(df: DataFrame, n: int = 5, trigger: str | None = "60 seconds",
                   checkpoint: str | None = None) -> StreamingQuery:
    """Print the first ``n`` rows of every micro-batch, untruncated (opt-in).

    A separate query on the console sink: it reads the source on its own
    and never adds an action to the main query's batches.
    """
    from changefeed.streaming.triggers import apply_trigger

    writer = (df.writeStream.format("console").option("numRows", str(n))
              .option("truncate", "false").outputMode("append"))
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return apply_trigger(writer, trigger).start()

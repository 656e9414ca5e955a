"""Triggers and run control."""

from __future__ import annotations

import time

from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

AVAILABLE_NOW = "available_now"
ONCE = "once"


def apply_trigger(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    """``"60 seconds"`` -> fixed-interval micro-batches; ``"available_now"``
    -> drain what is there (in several batches if the source caps them),
    then stop; ``"once"`` -> one batch; ``None`` -> as fast as possible."""
    if trigger is None:
        return writer
    if trigger == AVAILABLE_NOW:
        return writer.trigger(availableNow=True)
    if trigger == ONCE:
        return writer.trigger(once=True)
    return writer.trigger(processingTime=trigger)


def run_bounded(query: StreamingQuery, seconds: float | None = None,
                batch_end_seconds: float = 0) -> StreamingQuery:
    """Wait for the query to end (``seconds=None``: until it stops by
    itself), else stop it after ``seconds``.  Errors of the query are
    raised here.  A batch that runs at that time may take ``batch_end_seconds``
    more to commit, so that it needn't be done again."""
    if seconds is None:
        query.awaitTermination()
    elif not query.awaitTermination(seconds):
        stop_at_batch_end(query, batch_end_seconds)
    exc = query.exception()
    if exc is not None:
        raise exc
    return query


def stop_at_batch_end(query: StreamingQuery, seconds: float = 60, poll: float = 0.02) -> bool:
    """Stop the query between two batches; a batch that is still running
    after ``seconds`` is cut off (and redone on restart).  Returns whether
    the query was stopped, or had ended, between batches."""
    deadline = time.monotonic() + seconds
    begun = query.lastProgress
    between = False
    while query.isActive:
        now = query.lastProgress
        # Idle, or a batch has committed since: its progress is reported after the commit.
        between = not query.status["isTriggerActive"] or (now is not None and (
            begun is None or now.batchId != begun.batchId))
        if between or time.monotonic() >= deadline:
            break
        time.sleep(poll)
    else:
        between = query.exception() is None
    query.stop()
    return between


def start_at_tip(df, checkpoint: str) -> bool:
    """Mark what a streaming source has now as read, for a query that starts
    at the tip: its first run with this checkpoint reads only what comes later.

    ``df`` must be the source as the query will read it.  Nothing of the
    old input is read but its listing, as no action runs on the batches.  A
    checkpoint that has committed batches is left alone (False).  The query
    must write batch by batch (``sinks.append_outputs``, ``append_batches``):
    the log of Spark's own file sink wants batch 0.
    """
    spark = df.sparkSession
    from changefeed.sinks.publish import matching

    if matching(spark, f"{checkpoint.rstrip('/')}/commits/*"):
        return False
    query = (df.writeStream.foreachBatch(lambda batch, batch_id: None)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    run_bounded(query)
    return True


def run_all(queries: list[StreamingQuery], seconds: float | None = None) -> None:
    """Wait for all queries to end, at most ``seconds`` together, then stop
    those that still run.  When one fails the others are stopped and its
    error is raised."""
    deadline = None if seconds is None else time.monotonic() + seconds
    try:
        while active := [q for q in queries if q.isActive]:
            left = 1.0 if deadline is None else min(1.0, deadline - time.monotonic())
            if left <= 0 or any(q.exception() is not None for q in queries):
                break
            active[0].awaitTermination(left)  # raises the query's own error
    finally:
        for q in queries:
            q.stop()
    for q in queries:
        if q.exception() is not None:
            raise q.exception()


def drain(query: StreamingQuery) -> StreamingQuery:
    """Let a running query process everything that is available, then stop
    it (a fixed-interval query caught up, e.g. before maintenance)."""
    query.processAllAvailable()
    query.stop()
    exc = query.exception()
    if exc is not None:
        raise exc
    return query


def batch_bytes(spark, waves: int = 4) -> str:
    """A per-trigger byte cap that fills the cluster ``waves`` times.

    Draining a backlog in batches of this size keeps every core busy and
    commits progress regularly; a 100 TB backlog is not one giant batch.
    """
    per_task = spark.conf.get("spark.sql.files.maxPartitionBytes", "128m")
    per_task_bytes = _to_bytes(per_task)
    from changefeed.session import parallelism

    total = parallelism(spark) * per_task_bytes * waves
    return str(total)


def _to_bytes(size: str) -> int:
    size = size.strip().lower().rstrip("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    if size and size[-1] in units:
        return int(float(size[:-1]) * units[size[-1]])
    return int(size)

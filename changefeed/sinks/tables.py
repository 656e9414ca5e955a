"""Table and record-bus writers."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from changefeed.sinks.publish import publish, table_home
from changefeed.streaming.triggers import apply_trigger


def write_records(records: DataFrame, fmt: str = "parquet", path: str | None = None,
                  options: dict[str, str] | None = None, mode: str = "append") -> None:
    """Batch write of keyed records: a bus topic (``fmt="kafka"``, topic in
    ``options``) or files under ``path``."""
    writer = records.write.format(fmt).options(**(options or {}))
    if fmt == "kafka":
        writer.save()
    else:
        writer.mode(mode).save(path)


def append_stream(df: DataFrame, checkpoint: str, *, table: str | None = None,
                  path: str | None = None, fmt: str = "parquet", trigger: str = "60 seconds",
                  query_name: str | None = None, options: dict[str, str] | None = None,
                  partitions: int | None = None) -> StreamingQuery:
    """Append every micro-batch to a table (catalog ``table`` or files at
    ``path``; for ``fmt="kafka"``, a topic named in ``options``).

    The checkpoint records source progress and the sink's commit log, so a
    restarted query neither loses nor repeats a batch.  ``partitions`` bounds
    the number of files each batch adds.  It shuffles the finished rows
    (``repartition``) rather than ``coalesce``: coalescing would pull the
    whole batch, parse included, into that many tasks.

    A Parquet table fed by this sink is read through the sink's commit log,
    so it must have one writer, the stream: rows a batch job appends to the
    same folder stay invisible.  Table formats (``iceberg``, ``delta``) have no
    such limit.
    """
    if fmt != "kafka" and (table is None) == (path is None):
        raise ValueError("give exactly one of table or path")
    if partitions:
        df = df.repartition(partitions)
    writer = (
        df.writeStream.format(fmt)
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .options(**(options or {}))
    )
    writer = apply_trigger(writer, trigger)
    if query_name:
        writer = writer.queryName(query_name)
    if table is not None:
        return writer.toTable(table)
    if path is not None:
        return writer.start(path)
    return writer.start()


BATCH_COLUMN = "batch_id"
QUERY_COLUMN = "query_id"


def append_batches(df: DataFrame, checkpoint: str, path: str, *, fmt: str = "parquet",
                   trigger: str = "60 seconds", options: dict[str, str] | None = None,
                   app_id: str | None = None) -> StreamingQuery:
    """Streaming append through ``foreachBatch``, for formats with no
    streaming writer, made idempotent by the batch id.

    A micro-batch that is replayed after a failure (``foreachBatch`` is
    at-least-once) rewrites its own ``query_id=.../batch_id=N`` folder in
    overwrite mode instead of adding a second copy; a reader sees each batch
    once (the folder names become columns).  The query id is the one the
    checkpoint was created with: a new checkpoint, whose batch numbers start
    at 0 again, writes to folders of its own and leaves earlier rows alone.  For ``fmt="delta"`` the
    writer's transaction options (``txnAppId``/``txnVersion``) give the same
    guarantee on a single table.
    """
    owner: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        if not owner:
            meta = batch.sparkSession.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
            owner.append(json.loads(meta)["id"])
        folder = path if fmt == "delta" else f"{path}/{QUERY_COLUMN}={owner[0]}"
        batch_writer(folder, fmt=fmt, options=options, app_id=app_id or owner[0])(batch, batch_id)

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return apply_trigger(writer, trigger).start()


def batch_writer(path: str, *, fmt: str = "parquet", options: dict[str, str] | None = None,
                 app_id: str | None = None):
    """The ``(batch, batch_id)`` function :func:`append_batches` runs for
    each micro-batch; writing the same batch id twice leaves one copy."""
    opts = dict(options or {})

    def write(batch: DataFrame, batch_id: int) -> None:
        if fmt == "delta":
            (batch.write.format("delta").mode("append").options(**opts)
             .option("txnAppId", app_id or path).option("txnVersion", str(batch_id))
             .save(path))
        else:
            (batch.write.format(fmt).mode("overwrite").options(**opts)
             .save(f"{path}/{BATCH_COLUMN}={batch_id}"))

    return write


def overwrite(df: DataFrame, *, table: str | None = None, path: str | None = None,
              fmt: str = "parquet", atomic: bool | None = None) -> None:
    """Replace the whole table with ``df``.

    Re-running on the same input leaves the same table.  On a catalog whose
    format supports it (``iceberg``, ``delta``), ``writeTo().createOrReplace()``
    swaps the table; otherwise, for a catalog table, or a path with
    ``atomic=True``, :func:`changefeed.sinks.publish` writes a run of its own
    and shows it when complete (read such a path with ``sources.table``).
    ``atomic=False``, the default of a path, is a save-mode overwrite in place.
    """
    if (table is None) == (path is None):
        raise ValueError("give exactly one of table or path")
    if table is not None:
        if fmt in ("iceberg", "delta"):
            df.writeTo(table).using(fmt).createOrReplace()
        elif atomic is not False:
            publish(df, table_home(df.sparkSession, table), table=table, fmt=fmt)
        else:
            df.write.format(fmt).mode("overwrite").saveAsTable(table)
        return
    if atomic and fmt != "delta":
        publish(df, path, fmt=fmt)
    else:
        df.write.format(fmt).mode("overwrite").save(path)

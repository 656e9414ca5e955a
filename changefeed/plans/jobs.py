"""Jobs: ingest, streaming changes, daily per-domain summary.

Each job is a single declarative plan.  Parameters are function arguments;
the ``main`` entry points read them from ``spark.app.*`` settings so they
can be passed with ``spark-submit --conf``.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changefeed import operators as ops
from changefeed.plans.incremental import refresh, summary
from changefeed.sinks import BatchReport, Output, append_outputs, append_stream, overwrite, read_batches
from changefeed.sinks.tables import BATCH_COLUMN, QUERY_COLUMN
from changefeed.sources import feed_lines, record_stream, table
from changefeed.sources.feed import POSITION
from changefeed.streaming import BatchRowsListener, batch_bytes, observe_rows, run_all, start_at_tip

CHANGES_METRIC = "changes"


def ingest(lines: DataFrame, domains: Iterable[str] | None = None,
           line_col: str = "value", pretest: bool = True) -> DataFrame:
    """Feed lines -> keyed records ``(key, value)``.  Batch or streaming.

    ``pretest`` searches the raw text for the allowed domains before it is
    parsed (same rows; worth it for lists up to some dozens)."""
    framed = ops.frame(lines, line_col)
    if pretest:
        framed = ops.prefilter_domains(framed, domains)
    return ops.keyed(ops.filter_domains(ops.valid(framed), domains))


def ingest_rejects(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Data lines that ingest did not forward, with the reason."""
    return ops.rejects(ops.frame(lines, line_col))


def changes(records: DataFrame, time_zone: str | None = None,
            on_malformed: str = "keep") -> DataFrame:
    """Keyed records -> flat change rows.  Batch or streaming."""
    return ops.parse_records(records, time_zone=time_zone, on_malformed=on_malformed)


#: Columns of records written in feed order (besides ``batch_id``), in order.
SEQUENCE = (*POSITION, "place")


def stream_ingest(spark: SparkSession, lines_path: str, checkpoint: str, *,
                  records_path: str | None = None, records_table: str | None = None,
                  fmt: str = "parquet", options: dict[str, str] | None = None,
                  domains: Iterable[str] | None = None, trigger: str = "60 seconds",
                  max_files_per_trigger: int | None = None,
                  max_bytes_per_trigger: str | None = None,
                  source_options: dict[str, str] | None = None,
                  rejects_path: str | None = None, metrics_path: str | None = None,
                  ordered: bool = False, from_tip: bool = False,
                  on_batch: Callable[[BatchReport], None] | None = None) -> StreamingQuery:
    """Landed feed lines -> keyed records on a bus topic or a table.

    ``source_options`` go to the file source, e.g. ``cleanSource`` so that a
    long-running stream does not relist an ever-growing folder.

    ``rejects_path``: data lines that are not forwarded are appended there
    with their ``reason`` by the same batch (one read, one parse; see
    :func:`changefeed.sinks.append_outputs`), so records and rejects together
    are always the whole input, whatever happens between the two writes.
    ``metrics_path``: a durable row count per batch and output.  ``ordered``:
    records carry their place in the feed (:data:`SEQUENCE`; read them with
    :func:`records_in_order`).  ``from_tip``: a first run passes over what has
    landed before.  ``on_batch`` is called with each batch's report.
    """
    lines = feed_lines(spark, lines_path, streaming=True,
                       max_files_per_trigger=max_files_per_trigger,
                       max_bytes_per_trigger=max_bytes_per_trigger, options=source_options,
                       positions=ordered)
    if from_tip:
        start_at_tip(lines, checkpoint)
    if rejects_path is None and metrics_path is None and on_batch is None and not (ordered or from_tip):
        return append_stream(ingest(lines, domains), checkpoint, table=records_table,
                             path=records_path, fmt=fmt, trigger=trigger, options=options)
    where = tuple(POSITION) if ordered else ()
    framed = ops.frame(lines, keep=where)
    if rejects_path is None:  # else every line is judged, allowed or not
        framed = ops.prefilter_domains(framed, domains)

    def records(batch: DataFrame) -> DataFrame:
        if ordered:  # counted before anything is left out, in the order of the lines of a split
            batch = batch.withColumn("place", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)))
        kept = ops.filter_domains(batch.where(F.col("reason").isNull()), domains)
        return ops.keyed(kept, keep=() if fmt == "kafka" else SEQUENCE if ordered else ())

    outputs = [Output("records", records, path=None if fmt == "kafka" else records_path,
                      table=records_table, fmt=fmt, options=options or {})]
    if rejects_path is not None:
        outputs.append(Output("rejects", lambda batch: batch.where(F.col("reason").isNotNull()).select(
            "payload", "reason"), path=rejects_path))
    return append_outputs(ops.classify(framed), checkpoint, outputs, trigger=trigger,
                          metrics_path=metrics_path, on_batch=on_batch)


def records_in_order(spark: SparkSession, path: str) -> DataFrame:
    """Records that ``stream_ingest(ordered=True)`` wrote, sorted by key and,
    within a key, by their place in the feed: (key, value, batch_id, ...).

    A range sort on all of these columns: a key that holds a third of the
    records is spread over several partitions, which follow each other.
    """
    rows = read_batches(spark, path, keep_ids=True)
    return rows.orderBy("key", QUERY_COLUMN, BATCH_COLUMN, *SEQUENCE)


def stream_ingest_rejects(spark: SparkSession, lines_path: str, checkpoint: str, path: str, *,
                          trigger: str = "60 seconds",
                          max_files_per_trigger: int | None = None,
                          max_bytes_per_trigger: str | None = None) -> StreamingQuery:
    """Data lines that ingest does not forward, appended with their
    ``reason`` -- the table form of a reject log (opt-in).

    A query of its own next to :func:`stream_ingest`, with its own
    checkpoint: it reads the landed lines again and so parses each payload
    a second time; the forwarded records are never affected.
    """
    lines = feed_lines(spark, lines_path, streaming=True,
                       max_files_per_trigger=max_files_per_trigger,
                       max_bytes_per_trigger=max_bytes_per_trigger)
    return append_stream(ingest_rejects(lines), checkpoint, path=path, trigger=trigger)


def stream_changes(spark: SparkSession, checkpoint: str, *, source_fmt: str = "parquet",
                   source_path: str | None = None, source_options: dict[str, str] | None = None,
                   table: str | None = None, path: str | None = None, fmt: str = "parquet",
                   trigger: str = "60 seconds", time_zone: str | None = None,
                   on_malformed: str = "keep", quarantine_path: str | None = None,
                   quarantine_checkpoint: str | None = None,
                   max_files_per_trigger: int | None = None,
                   max_bytes_per_trigger: str | None = None,
                   partitions: int | None = None,
                   options: dict[str, str] | None = None, metrics_path: str | None = None,
                   sample: int = 0, on_batch: Callable[[BatchReport], None] | None = None,
                   from_tip: bool = False, target_file_bytes: int | None = None) -> list[StreamingQuery]:
    """Keyed records -> parse -> flatten -> append, one micro-batch per
    trigger.

    Rows per batch are published as the ``changes`` observed metric.  With
    ``on_malformed="quarantine"`` malformed payloads are left out of the
    table and appended to ``quarantine_path``, which must be given, by the
    same batch of the same query: table and quarantine together are always the whole
    input (``quarantine_checkpoint`` is no longer used).  ``metrics_path``: a durable
    row count per batch and output; ``sample`` and ``on_batch``: a report of
    each batch with so many of its rows.  ``from_tip``: a first run passes over
    what is there (for a topic the source's own option does that).
    ``partitions`` bounds the files each batch writes, ``target_file_bytes``
    chooses their number by the last batch's bytes, and ``options`` go to
    the sink.  Returns the started query in a list.
    """
    if on_malformed == "quarantine" and quarantine_path is None:
        raise ValueError("quarantine needs a quarantine_path")
    records = record_stream(spark, source_fmt, source_path, source_options,
                            max_files_per_trigger=max_files_per_trigger,
                            max_bytes_per_trigger=max_bytes_per_trigger)
    if from_tip and source_fmt != "kafka":
        start_at_tip(records, checkpoint)
    batched = metrics_path or on_batch or sample or from_tip or target_file_bytes
    if quarantine_path is None and not batched:
        flat = observe_rows(changes(records, time_zone, on_malformed), CHANGES_METRIC)
        return [append_stream(flat, checkpoint, table=table, path=path, fmt=fmt, trigger=trigger,
                              options=options, partitions=partitions)]

    def main(rows) -> Output:
        return Output("changes", rows, path=path, table=table, fmt=fmt, options=options or {}, partitions=partitions,
                      target_file_bytes=target_file_bytes)

    if quarantine_path is None:
        outputs = [main(lambda batch: batch)]
        source = observe_rows(changes(records, time_zone, on_malformed), CHANGES_METRIC)
    else:
        keep = on_malformed == "keep"
        source = (records.select(records["value"].cast("string").alias("payload"))
                  .withColumn("well_formed", ops.reads_as_object("payload"))
                  .observe(CHANGES_METRIC, F.count_if(F.lit(keep) | F.col("well_formed")).alias("n")))
        outputs = [main(lambda batch: ops.flatten(ops.parse(batch if keep else batch.where("well_formed")), time_zone)),
                   Output("quarantine", lambda batch: batch.where("NOT well_formed").select("payload"),
                          path=quarantine_path)]
    return [append_outputs(source, checkpoint, outputs, trigger=trigger, metrics_path=metrics_path,
                           sample=sample, on_batch=on_batch)]


def summarize(changes_df: DataFrame) -> DataFrame:
    """Edits per domain, most first."""
    return ops.ranked(ops.domain_counts(changes_df, "domain"))


def domain_edit_counts(spark: SparkSession, *, src_table: str | None = None,
                       src_path: str | None = None, dst_table: str | None = None,
                       dst_path: str | None = None, fmt: str = "parquet",
                       partials_path: str | None = None) -> None:
    """Count the changes table per domain and replace the summary.

    The summary is replaced as a whole: readers see the old one until the new
    one is complete (read a ``dst_path`` with ``sources.table``).  Source and target must differ.  With ``partials_path``
    (source a path written batch by batch) counts are kept there per commit
    and only commits without counts are read; else the whole table is.
    """
    src = src_table or src_path
    dst = dst_table or dst_path
    if src is None or dst is None:
        raise ValueError("need a source and a target")
    if src == dst:
        raise ValueError("source and target of the summary must differ")
    if partials_path is not None:
        if src_path is None:
            raise ValueError("counts per commit need a source path")
        refresh(spark, src_path, partials_path, fmt=fmt)
        counts = summary(spark, partials_path)
    else:
        counts = summarize(table(spark, src_table, src_path, fmt))
    overwrite(counts, table=dst_table, path=dst_path, fmt=fmt, atomic=fmt != "delta")


def changed_domains(records: DataFrame, value_col: str = "value") -> DataFrame:
    """Keyed records -> ``domain`` only, for a summary straight from records."""
    return ops.domains(records.select(records[value_col].cast("string").alias("payload")))


def _conf(spark: SparkSession, key: str, default: str | None = None) -> str | None:
    return spark.conf.get(f"spark.app.{key}", default)


CHANGES_TABLE = "recent_changes_stream"
SUMMARY_TABLE = "domain_edit_counts"


def _table_name(spark: SparkSession, name: str) -> str:
    """``[catalog.][db.]name`` from ``spark.app.catalog`` / ``spark.app.db``."""
    return ".".join(p for p in (_conf(spark, "catalog"), _conf(spark, "db"), name) if p)


def _prefixed(spark: SparkSession, prefix: str) -> dict[str, str]:
    """``spark.app.<prefix>.*`` settings (static or runtime) as options."""
    full = f"spark.app.{prefix}."
    return {k[len(full):]: v for k, v in spark.conf.getAll.items() if k.startswith(full)}


def _caps(spark: SparkSession) -> dict:
    """``spark.app.maxFilesPerTrigger`` / ``maxBytesPerTrigger``; with neither,
    a byte cap that fills the cluster, so a backlog is never one batch."""
    files, size = _conf(spark, "maxFilesPerTrigger"), _conf(spark, "maxBytesPerTrigger")
    return {"max_files_per_trigger": int(files) if files else None,
            "max_bytes_per_trigger": size or (None if files else batch_bytes(spark))}


def _seconds(spark: SparkSession) -> float | None:
    value = _conf(spark, "runSeconds")
    return float(value) if value else None


def batch_main(spark: SparkSession | None = None) -> None:
    """``spark-submit`` entry of the daily summary.

    ``spark.app.catalog`` (optional), ``spark.app.db``, ``spark.app.format``.
    """
    from changefeed.session import build_session

    spark = spark or build_session("changefeed-batch")
    domain_edit_counts(spark, src_table=_table_name(spark, CHANGES_TABLE),
                       dst_table=_table_name(spark, SUMMARY_TABLE),
                       fmt=_conf(spark, "format", "parquet"))


def ingest_main(spark: SparkSession | None = None) -> None:
    """``spark-submit`` entry of the ingest stream; runs until stopped, or
    for ``spark.app.runSeconds`` seconds.

    ``spark.app.linesPath`` (landed feed files), ``spark.app.checkpoint``,
    ``spark.app.domains`` (comma-separated allow-list; empty = all),
    ``spark.app.sinkFormat`` (default ``kafka``) with ``spark.app.sink.*``
    options (e.g. ``topic``, ``kafka.bootstrap.servers``), or
    ``spark.app.recordsPath`` for a file sink.  With ``spark.app.rejectsPath``
    the same batches append the reject log; ``spark.app.metricsPath`` keeps a row
    count per batch, ``spark.app.fromTip=true`` passes over what has landed
    before a first run, ``spark.app.ordered=true`` writes each record's place in the feed.
    ``spark.app.source.*`` are options of the file source,
    ``spark.app.maxFilesPerTrigger`` and ``spark.app.maxBytesPerTrigger``
    bound a batch.
    """
    from changefeed.session import build_session

    spark = spark or build_session("changefeed-ingest")
    sink_options = _prefixed(spark, "sink")
    domains = [d.strip() for d in (_conf(spark, "domains", "") or "").split(",") if d.strip()]
    trigger = _conf(spark, "trigger", "60 seconds")
    query = stream_ingest(
        spark, _conf(spark, "linesPath"), _conf(spark, "checkpoint"),
        records_path=_conf(spark, "recordsPath"),
        fmt=_conf(spark, "sinkFormat", "kafka"), options=sink_options, domains=domains,
        trigger=trigger, source_options=_prefixed(spark, "source"),
        rejects_path=_conf(spark, "rejectsPath"), metrics_path=_conf(spark, "metricsPath"),
        ordered=_flag(spark, "ordered"), from_tip=_flag(spark, "fromTip"), **_caps(spark))
    run_all([query], _seconds(spark))


def _flag(spark: SparkSession, key: str) -> bool:
    return (_conf(spark, key, "false") or "").strip().lower() == "true"


def _report(name: str | None, batch_id: int, rows: int) -> None:
    print(f"batch {batch_id}: {rows} rows", flush=True)


def streaming_main(spark: SparkSession | None = None) -> None:
    """``spark-submit`` entry of the streaming job; runs until stopped, or for
    ``spark.app.runSeconds`` seconds, and prints each batch's row count.

    ``spark.app.sourceFormat`` and ``spark.app.source.*`` options (e.g. a
    bus topic), ``spark.app.catalog``/``db``, ``spark.app.checkpoint``,
    ``spark.app.trigger`` (default ``60 seconds``), ``spark.app.format`` and
    ``spark.app.sink.*`` options, ``spark.app.timeZone``,
    ``spark.app.partitions`` (files a batch),
    ``spark.app.maxFilesPerTrigger`` / ``maxBytesPerTrigger``,
    ``spark.app.quarantinePath``, ``spark.app.targetFileBytes``, ``spark.app.metricsPath`` and
    ``spark.app.fromTip``.
    """
    from changefeed.session import build_session

    spark = spark or build_session("changefeed-streaming")
    partitions, quarantine = _conf(spark, "partitions"), _conf(spark, "quarantinePath")
    source_options = _prefixed(spark, "source")
    queries = stream_changes(
        spark,
        _conf(spark, "checkpoint"),
        source_fmt=_conf(spark, "sourceFormat", "kafka"),
        source_path=_conf(spark, "sourcePath"),
        source_options=source_options,
        table=_table_name(spark, CHANGES_TABLE),
        fmt=_conf(spark, "format", "parquet"),
        trigger=_conf(spark, "trigger", "60 seconds"),
        time_zone=_conf(spark, "timeZone"),
        on_malformed="quarantine" if quarantine else "keep",
        quarantine_path=quarantine,
        metrics_path=_conf(spark, "metricsPath"),
        from_tip=_flag(spark, "fromTip"),
        partitions=int(partitions) if partitions else None,
        target_file_bytes=int(_conf(spark, "targetFileBytes", "0")) or None,
        options=_prefixed(spark, "sink"),
        **_caps(spark),
    )
    counts = BatchRowsListener(CHANGES_METRIC, callback=_report)
    spark.streams.addListener(counts)
    try:
        run_all(queries, _seconds(spark))
    finally:
        spark.streams.removeListener(counts)


if __name__ == "__main__":  # pragma: no cover
    _commands = {"batch": batch_main, "ingest": ingest_main, "streaming": streaming_main}
    if len(sys.argv) != 2 or sys.argv[1] not in _commands:
        sys.exit(f"usage: jobs.py {{{'|'.join(_commands)}}}  (parameters: --conf spark.app.*)")
    _commands[sys.argv[1]]()

"""Registered queries over the driver's tables, each with a DuckDB oracle.

Every query reads the whole ``events`` (or ``pages`` / ``documents``)
table.  Change-feed queries first render ``events`` as feed lines with
:func:`changefeed.sources.render_feed`; the oracles compute the expected
rows straight from the ``events`` columns with string concatenation and
arithmetic, never by parsing JSON, so they are independent of the code
they check.  Queries that write (sinks, streams) do so under a fresh folder
in the shared checkpoint directory and return the table read back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed import operators as ops
from changefeed.functions import url_host
from changefeed.plans import jobs
from changefeed.session import shared_dir
from changefeed.sinks import BatchReport, append_batches, append_stream, read_batches, read_metrics, write_records
from changefeed.sources import feed_lines, json_events, read_records, render_feed, table
from changefeed.streaming import BatchRowsListener, batch_bytes, drain, preview, run_bounded, stop_at_batch_end

TZ = "UTC"
ALLOW_LIST = ("click.example.org", "view.example.org")


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ops.spread(_t(spark, sf_dir, "events"))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return render_feed(_events(spark, sf_dir))


def _with_id(framed: DataFrame) -> DataFrame:
    """Valid records as (event id, domain); the id comes from the one parse."""
    kept = ops.valid(framed, fields=["id"])
    return kept.select(F.col("id").try_cast("long").alias("event_id"), "domain")


# -- ingest -----------------------------------------------------------------

def feed_data_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1, FLT1, PRJ5: event lines framed to their payload."""
    return ops.frame(_lines(spark, sf_dir))


def ingest_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT2, FLT3, PRJ7: forwarded records (event id, domain)."""
    return _with_id(ops.frame(_lines(spark, sf_dir)))


def ingest_allowlist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT4: forwarded records of the allow-listed domains."""
    framed = ops.prefilter_domains(ops.frame(_lines(spark, sf_dir)), ALLOW_LIST)
    return ops.filter_domains(_with_id(framed), ALLOW_LIST)


def ingest_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ8, PRJ9, SNK1: keyed records, counted per key."""
    records = jobs.ingest(_lines(spark, sf_dir))
    return records.groupBy("key").agg(F.count(F.lit(1)).alias("record_count"))


def ingest_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PRJ8, PRJ9, SNK1: the written records, key and payload text."""
    base = shared_dir(spark, "records")
    write_records(jobs.ingest(_lines(spark, sf_dir)), path=base)
    return read_records(spark, path=base).select("key", F.col("value").cast("string").alias("payload"))


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT2, FLT3 rejects: data lines not forwarded, with the reason."""
    return jobs.ingest_rejects(_lines(spark, sf_dir))


# -- parse / flatten / summaries --------------------------------------------

def changes_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3, PRJ1-4, PRJ6: keyed records parsed and flattened."""
    return jobs.changes(jobs.ingest(_lines(spark, sf_dir)), time_zone=TZ)


def domain_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG1, SRT1: edits per domain, most first."""
    return jobs.summarize(jobs.changed_domains(jobs.ingest(_lines(spark, sf_dir))))


def summary_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT1: the place of every domain in the written summary, read back in
    file order."""
    base = shared_dir(spark, "summary-order")
    domain_edit_counts(spark, sf_dir).coalesce(1).write.parquet(f"{base}/summary")
    rows = spark.read.parquet(f"{base}/summary")  # one row per domain, one file
    return rows.withColumn("place", F.monotonically_increasing_id() + 1)


def page_domain_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG1, SRT1 over real URLs: pages per host."""
    pages = _t(spark, sf_dir, "pages")
    return ops.ranked(ops.domain_counts(pages, url_host("url")))


def source_domain_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG1 over ``documents.source``."""
    docs = _t(spark, sf_dir, "documents")
    return ops.ranked(ops.domain_counts(docs, "source"))


def parse_permissive_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3 on every data line, unvalidated: malformed text -> null row."""
    return ops.flatten(ops.parse(ops.frame(_lines(spark, sf_dir))), TZ)


def parse_quarantine_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """on_malformed='quarantine': well-formed payloads only."""
    return ops.flatten(ops.parse(ops.well_formed(ops.frame(_lines(spark, sf_dir)))), TZ)


def parse_quarantine_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantined payloads."""
    return ops.malformed(ops.frame(_lines(spark, sf_dir)))


# -- sinks and jobs -------------------------------------------------------

def summary_overwrite_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK1 (batch), SRC2 (batch), SRC4, SNK3, JOB3 run twice."""
    base = shared_dir(spark, "summary")
    write_records(jobs.ingest(_lines(spark, sf_dir)), path=f"{base}/records")
    flat = jobs.changes(read_records(spark, path=f"{base}/records"), time_zone=TZ)
    flat.write.mode("append").parquet(f"{base}/recent_changes_stream")
    for _ in range(2):
        jobs.domain_edit_counts(spark, src_path=f"{base}/recent_changes_stream",
                                dst_path=f"{base}/domain_edit_counts")
    return table(spark, path=f"{base}/domain_edit_counts")


class _StreamBed:
    """Landing folder -> ingest stream -> records -> changes stream -> table."""

    def __init__(self, spark: SparkSession, name: str, files_per_trigger: int | None = None):
        self.spark = spark
        # Backlogs drain in cluster-sized batches unless a file cap is given.
        self.files_per_trigger = files_per_trigger
        self.bytes_per_trigger = None if files_per_trigger else batch_bytes(spark)
        self.base = shared_dir(spark, name)
        self.landing = f"{self.base}/landing"
        self.records = f"{self.base}/records"
        self.changes = f"{self.base}/recent_changes_stream"
        # Counted by the changes queries' own metric.
        self.rows = self.batches = 0

    def land(self, lines: DataFrame) -> None:
        lines.select("value").write.mode("append").text(self.landing)

    def run(self) -> None:
        run_bounded(jobs.stream_ingest(
            self.spark, self.landing, f"{self.base}/_ckpt_ingest", records_path=self.records,
            trigger="available_now", max_files_per_trigger=self.files_per_trigger,
            max_bytes_per_trigger=self.bytes_per_trigger))
        counts = BatchRowsListener(jobs.CHANGES_METRIC)
        self.spark.streams.addListener(counts)
        try:
            for q in jobs.stream_changes(
                    self.spark, f"{self.base}/_ckpt_changes", source_path=self.records,
                    path=self.changes, trigger="available_now", time_zone=TZ,
                    max_files_per_trigger=self.files_per_trigger,
                    max_bytes_per_trigger=self.bytes_per_trigger):
                run_bounded(q)
                self.rows += counts.total(q)
                self.batches += counts.totals.get(str(q.id), (0, 0))[1]
        finally:
            self.spark.streams.removeListener(counts)

    def table(self) -> DataFrame:
        return self.spark.read.parquet(self.changes)


def stream_changes_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1 + SRC2 streaming, SNK2, STR1-4, JOB2 with availableNow."""
    bed = _StreamBed(spark, "stream-append")
    bed.land(_lines(spark, sf_dir))
    bed.run()
    return bed.table()


def end_to_end_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB1 -> JOB2 -> JOB3: ingest stream, changes stream, then the daily
    summary over the streamed table."""
    bed = _StreamBed(spark, "end-to-end")
    bed.land(_lines(spark, sf_dir))
    bed.run()
    summary = f"{bed.base}/domain_edit_counts"
    jobs.domain_edit_counts(spark, src_path=bed.changes, dst_path=summary)
    return table(spark, path=summary)


def stream_restart_no_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR2, STR3, STR6: run, restart with nothing new, land more, run."""
    bed = _StreamBed(spark, "stream-restart")
    events = _events(spark, sf_dir)
    # Split the feed in time: the earlier half lands first.
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    lines = render_feed(events, keep_ts=True)
    if lo is None:  # no events: one empty landing, nothing to split
        bed.land(lines)
        bed.run()
        return bed.table()
    mid = lo + (hi - lo) / 2
    early = F.coalesce(F.col("ts") < F.lit(mid), F.lit(True))  # no time: with the earlier half
    bed.land(lines.where(early))
    bed.run()
    bed.run()
    bed.land(lines.where(~early))
    bed.run()
    return bed.table()


def stream_empty_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT5: a second start with no new input writes nothing."""
    bed = _StreamBed(spark, "stream-empty")
    bed.land(_lines(spark, sf_dir))
    bed.run()
    bed.run()
    return bed.table()


def batch_row_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG2: rows written, summed over the batches' observed metric."""
    bed = _StreamBed(spark, "stream-metrics")
    bed.land(_lines(spark, sf_dir))
    bed.run()
    return spark.range(1).select(F.lit(bed.rows).cast("long").alias("n"))


def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT2: how many rows a preview of 5 shows, how many of them are in the
    table, and the table's rows."""
    flat = changes_flat(spark, sf_dir)
    shown = preview(flat, 5).select("event_id")
    known = shown.join(flat.select("event_id"), "event_id", "left_semi")
    one = [shown.agg(F.count(F.lit(1)).alias("n_shown")), known.agg(F.count(F.lit(1)).alias("n_known")),
           flat.agg(F.count(F.lit(1)).alias("n_rows"))]
    return one[0].join(one[1], F.lit(True)).join(one[2], F.lit(True))


def landed_feed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC1 over landed text files (batch read of the landing folder)."""
    base = shared_dir(spark, "landed")
    _lines(spark, sf_dir).write.text(f"{base}/landing")
    return ops.frame(feed_lines(spark, f"{base}/landing"))


def _stream_quarantine(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Unvalidated records (as another producer might send them) streamed
    with ``on_malformed="quarantine"``; returns (table path, quarantine path)."""
    base = shared_dir(spark, "stream-quarantine")
    framed = ops.frame(_lines(spark, sf_dir))
    records = framed.select(F.lit(None).cast("string").alias("key"),
                            F.col("payload").cast("binary").alias("value"))
    write_records(records, path=f"{base}/records")
    for q in jobs.stream_changes(
            spark, f"{base}/_ckpt_changes", source_path=f"{base}/records",
            path=f"{base}/recent_changes_stream", trigger="available_now", time_zone=TZ,
            on_malformed="quarantine", quarantine_path=f"{base}/quarantine",
            max_bytes_per_trigger=batch_bytes(spark)):
        run_bounded(q)
    return f"{base}/recent_changes_stream", f"{base}/quarantine"


def stream_quarantine_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB2 with quarantine: the table holds only well-formed payloads."""
    return read_batches(spark, _stream_quarantine(spark, sf_dir)[0])


def stream_quarantine_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB2 with quarantine: the side table holds the malformed payloads."""
    return read_batches(spark, _stream_quarantine(spark, sf_dir)[1])


def stream_ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FLT2, FLT3 as a stream: the reject log, written by the ingest's own batches."""
    return read_batches(spark, f"{_split_ingest(spark, sf_dir)}/rejects")


def _split_ingest(spark: SparkSession, sf_dir: str, name: str = "stream-rejects") -> str:
    """Records, rejects and batch counts of one ingest query that is stopped
    and started again, each time with half of the feed more; its folder."""
    base = shared_dir(spark, name)
    lines = render_feed(_events(spark, sf_dir), keep_id=True)
    for half in ("event_id % 2 = 0", "NOT coalesce(event_id % 2 = 0, false)"):
        lines.where(half).select("value").write.mode("append").text(f"{base}/landing")
        run_bounded(jobs.stream_ingest(
            spark, f"{base}/landing", f"{base}/_ckpt", records_path=f"{base}/records",
            rejects_path=f"{base}/rejects", metrics_path=f"{base}/metrics", trigger="available_now",
            max_bytes_per_trigger=batch_bytes(spark)))
    return base


def durable_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG2, STR4: rows per output, added up from the counts that two runs
    of a query left for each batch."""
    counts = read_metrics(spark, f"{_split_ingest(spark, sf_dir, 'batch-counts')}/metrics")
    return counts.groupBy("output").agg(F.sum("n_rows").alias("n_rows"))


def stream_tip_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR3: a first run from the tip reads only what lands after it was set."""
    base = shared_dir(spark, "stream-tip")
    lines = render_feed(_events(spark, sf_dir), keep_id=True)

    def land(which):
        lines.where(which).select("value").write.mode("append").text(f"{base}/landing")

    def run():
        run_bounded(jobs.stream_ingest(spark, f"{base}/landing", f"{base}/_ckpt", records_path=f"{base}/records",
                                       trigger="available_now", from_tip=True,
                                       max_bytes_per_trigger=batch_bytes(spark)))

    land("event_id % 3 = 0")
    run()
    land("NOT coalesce(event_id % 3 = 0, false)")
    run()
    run()
    return jobs.changes(read_records(spark, path=f"{base}/records"), TZ)


def ingest_record_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK1, SRC2: records with their batch, the feed landing in four parts."""
    base = shared_dir(spark, "record-order")
    lines = render_feed(_events(spark, sf_dir), keep_id=True)
    for part in range(4):
        lines.where(f"pmod(coalesce(event_id, 0), 4) = {part}").select("value").write.mode("append").text(
            f"{base}/landing")
        run_bounded(jobs.stream_ingest(spark, f"{base}/landing", f"{base}/_ckpt", records_path=f"{base}/records",
                                       trigger="available_now", ordered=True))
    rows = jobs.records_in_order(spark, f"{base}/records")
    return rows.select("key", F.col("value").cast("string").alias("payload"), F.col("batch_id").cast("long"))


def summary_by_commits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AGG1, SRC4, JOB3: counts per commit of the changes table, refreshed
    after each of two runs of the stream, published as the summary."""
    base = shared_dir(spark, "by-commits")
    lines = render_feed(_events(spark, sf_dir), keep_id=True)
    for half in ("event_id % 2 = 0", "NOT coalesce(event_id % 2 = 0, false)"):
        write_records(jobs.ingest(lines.where(half)), path=f"{base}/records")
        for q in jobs.stream_changes(spark, f"{base}/_ckpt", source_path=f"{base}/records",
                                     path=f"{base}/changes", trigger="available_now", time_zone=TZ,
                                     metrics_path=f"{base}/metrics", max_bytes_per_trigger=batch_bytes(spark)):
            run_bounded(q)
        jobs.domain_edit_counts(spark, src_path=f"{base}/changes", dst_path=f"{base}/summary",
                                partials_path=f"{base}/partials")
    return table(spark, path=f"{base}/summary")


def stream_batch_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRT2, AGG2: what the batches' own reports show: rows counted, and how
    many of the sampled rows are in the table (five a batch)."""
    base = shared_dir(spark, "batch-preview")
    write_records(jobs.ingest(_lines(spark, sf_dir)), path=f"{base}/records")
    reports: list[BatchReport] = []
    for q in jobs.stream_changes(spark, f"{base}/_ckpt", source_path=f"{base}/records", path=f"{base}/changes",
                                 trigger="available_now", time_zone=TZ, sample=5, on_batch=reports.append):
        run_bounded(q)
    shown = [r["event_id"] for report in reports for r in report.sample]  # five a batch
    rows = read_batches(spark, f"{base}/changes")
    return rows.agg(F.count_if(F.col("event_id").isin(shown)).alias("n_known"),
                    F.lit(sum(r.counts["changes"] for r in reports)).cast("long").alias("n_counted"),
                    F.count(F.lit(1)).alias("n_rows"))


def app_settings_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB1-4: the three entry points, driven by ``spark.app.*`` settings."""
    base = shared_dir(spark, "app-settings")
    db = "changefeed_" + base.rsplit("-", 1)[1]
    _lines(spark, sf_dir).write.text(f"{base}/landing")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{base}/db'")
    settings = {"linesPath": f"{base}/landing", "checkpoint": f"{base}/_ckpt_ingest", "sinkFormat": "parquet",
                "recordsPath": f"{base}/records", "rejectsPath": f"{base}/rejects", "trigger": "available_now",
                "sourceFormat": "parquet", "sourcePath": f"{base}/records", "db": db, "timeZone": TZ}
    try:
        for main, own in ((jobs.ingest_main, {}), (jobs.streaming_main, {"checkpoint": f"{base}/_ckpt_changes"}),
                          (jobs.batch_main, {})):
            for key, value in (settings | own).items():
                spark.conf.set(f"spark.app.{key}", value)
            main(spark)
        spark.read.table(f"{db}.{jobs.SUMMARY_TABLE}").write.parquet(f"{base}/out")
    finally:
        for key in settings:
            spark.conf.unset(f"spark.app.{key}")
        spark.sql(f"DROP DATABASE {db} CASCADE")
    return spark.read.parquet(f"{base}/out")


def stream_until_stopped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR1, STR5, STR6: a query without an end of its own, stopped between
    two batches once it has caught up; nothing is left to be redone."""
    base = shared_dir(spark, "until-stopped")
    _lines(spark, sf_dir).write.text(f"{base}/landing")
    query = jobs.stream_ingest(spark, f"{base}/landing", f"{base}/_ckpt", records_path=f"{base}/records",
                               trigger="1 second", max_bytes_per_trigger=batch_bytes(spark))
    query.processAllAvailable()
    stop_at_batch_end(query)
    return jobs.changes(read_records(spark, path=f"{base}/records"), TZ)


def stream_changes_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR4 via foreachBatch: each micro-batch written under its batch id."""
    base = shared_dir(spark, "stream-batches")
    _lines(spark, sf_dir).write.text(f"{base}/landing")
    lines = feed_lines(spark, f"{base}/landing", streaming=True,
                       max_bytes_per_trigger=batch_bytes(spark))
    run_bounded(append_batches(jobs.changes(jobs.ingest(lines), TZ), f"{base}/_ckpt",
                               f"{base}/out", trigger="available_now"))
    return spark.read.parquet(f"{base}/out").drop("batch_id", "query_id")


def stream_processing_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """STR1: a fixed-interval trigger, drained and stopped once caught up."""
    base = shared_dir(spark, "stream-interval")
    _lines(spark, sf_dir).write.text(f"{base}/landing")
    lines = feed_lines(spark, f"{base}/landing", streaming=True,
                       max_bytes_per_trigger=batch_bytes(spark))
    drain(append_stream(jobs.changes(jobs.ingest(lines), TZ), f"{base}/_ckpt",
                        path=f"{base}/out", trigger="1 second"))
    return spark.read.parquet(f"{base}/out")


def catalog_tables_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK2, SRC4, SNK3, JOB3 over catalog tables: stream to a table, then
    the daily summary from it into another."""
    base = shared_dir(spark, "catalog")
    name = "changefeed_" + base.rsplit("-", 1)[1]
    write_records(jobs.ingest(_lines(spark, sf_dir)), path=f"{base}/records")
    for q in jobs.stream_changes(spark, f"{base}/_ckpt", source_path=f"{base}/records",
                                 table=f"{name}_changes", trigger="available_now", time_zone=TZ,
                                 max_bytes_per_trigger=batch_bytes(spark)):
        run_bounded(q)
    jobs.domain_edit_counts(spark, src_table=f"{name}_changes", dst_table=f"{name}_summary")
    spark.read.table(f"{name}_summary").write.parquet(f"{base}/out")
    for t in ("changes", "summary"):
        spark.sql(f"DROP TABLE {name}_{t}")
    return spark.read.parquet(f"{base}/out")


def json_events_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC3 batch form: well-formed payloads landed as JSON Lines, scanned
    with the fixed schema and flattened."""
    base = shared_dir(spark, "json-events")
    framed = ops.well_formed(ops.frame(_lines(spark, sf_dir)))
    framed.select(F.col("payload").alias("value")).write.text(f"{base}/json")
    return ops.flatten(json_events(spark, f"{base}/json"), TZ)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "feed_data_lines": feed_data_lines,
    "landed_feed_lines": landed_feed_lines,
    "ingest_valid": ingest_valid,
    "ingest_allowlist": ingest_allowlist,
    "ingest_keyed": ingest_keyed,
    "ingest_records": ingest_records,
    "ingest_rejects": ingest_rejects,
    "changes_flat": changes_flat,
    "domain_edit_counts": domain_edit_counts,
    "summary_order": summary_order,
    "catalog_tables_summary": catalog_tables_summary,
    "page_domain_counts": page_domain_counts,
    "source_domain_counts": source_domain_counts,
    "summary_overwrite_twice": summary_overwrite_twice,
    "stream_changes_append": stream_changes_append,
    "end_to_end_summary": end_to_end_summary,
    "stream_restart_no_duplicates": stream_restart_no_duplicates,
    "parse_permissive_nulls": parse_permissive_nulls,
    "parse_quarantine_kept": parse_quarantine_kept,
    "parse_quarantine_rejected": parse_quarantine_rejected,
    "json_events_flat": json_events_flat,
    "stream_quarantine_kept": stream_quarantine_kept,
    "stream_changes_batches": stream_changes_batches,
    "stream_ingest_rejects": stream_ingest_rejects,
    "stream_processing_time": stream_processing_time,
    "stream_quarantine_rejected": stream_quarantine_rejected,
    "stream_empty_batch": stream_empty_batch,
    "batch_row_metrics": batch_row_metrics,
    "preview_rows": preview_rows,
    "durable_batch_counts": durable_batch_counts,
    "stream_tip_start": stream_tip_start,
    "ingest_record_order": ingest_record_order,
    "summary_by_commits": summary_by_commits,
    "stream_batch_preview": stream_batch_preview,
    "app_settings_run": app_settings_run,
    "stream_until_stopped": stream_until_stopped,
}

"""Streaming = batch; restarts add nothing; later files add only their rows."""

from collections import Counter

from pyspark.sql import functions as F

from conftest import SF_CHECK, SF_SMOKE

from changefeed import operators as ops
from changefeed.plans import jobs, queries
from changefeed.session import shared_dir
from changefeed.sinks import write_records
from changefeed.sources import render_feed
from changefeed.streaming import run_bounded


def _bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_stream_equals_batch(spark):
    streamed = queries.stream_changes_append(spark, SF_CHECK)
    assert _bag(streamed) == _bag(queries.changes_flat(spark, SF_CHECK))


def test_restart_adds_nothing_and_new_files_add_only_theirs(spark):
    bed = queries._StreamBed(spark, "t-restart", files_per_trigger=2)
    events = spark.read.parquet(f"{SF_SMOKE}/events.parquet")
    lines = render_feed(events, keep_ts=True)
    lo, hi = events.agg(F.min("ts"), F.max("ts")).first()
    mid = lo + (hi - lo) / 2
    bed.land(lines.where(F.col("ts") < F.lit(mid)))
    bed.run()
    n1 = bed.table().count()
    seen = (bed.rows, bed.batches)
    bed.run()
    assert bed.table().count() == n1
    assert (bed.rows, bed.batches) == seen  # no new input: no batch with data ran
    bed.land(lines.where(F.col("ts") >= F.lit(mid)))
    bed.run()
    whole = queries.changes_flat(spark, SF_SMOKE)
    assert 0 < n1 < whole.count()
    assert _bag(bed.table()) == _bag(whole)


def test_metrics_per_batch_sum_to_rows(spark):
    bed = queries._StreamBed(spark, "t-metrics", files_per_trigger=2)
    bed.land(queries._lines(spark, SF_CHECK))
    bed.run()
    assert bed.batches > 1  # the backlog is drained in several batches
    assert bed.rows == bed.table().count() == 9412


def test_quarantine_stream(spark):
    base = shared_dir(spark, "t-quarantine")
    framed = ops.frame(queries._lines(spark, SF_SMOKE))
    records = framed.select(F.lit("k").alias("key"), F.col("payload").cast("binary").alias("value"))
    write_records(records, path=f"{base}/records")
    started = jobs.stream_changes(
        spark, f"{base}/_ckpt", source_path=f"{base}/records", path=f"{base}/out",
        trigger="available_now", time_zone="UTC", on_malformed="quarantine",
        quarantine_path=f"{base}/bad", quarantine_checkpoint=f"{base}/_ckpt_bad")
    for q in started:
        run_bounded(q)
    good = spark.read.parquet(f"{base}/out").count()
    bad = spark.read.parquet(f"{base}/bad").count()
    assert good + bad == framed.count()
    assert bad == ops.malformed(framed).count() > 0


def test_catalog_tables_end_to_end(spark):
    """Stream into a catalog table, then the daily job over catalog tables."""
    spark.sql("CREATE DATABASE IF NOT EXISTS cf_test")
    base = shared_dir(spark, "t-catalog")
    write_records(jobs.ingest(queries._lines(spark, SF_SMOKE)), path=f"{base}/records")
    for q in jobs.stream_changes(spark, f"{base}/_ckpt", source_path=f"{base}/records",
                                 table="cf_test.recent_changes_stream", trigger="available_now",
                                 time_zone="UTC"):
        run_bounded(q)
    spark.conf.set("spark.app.db", "cf_test")
    try:
        jobs.batch_main(spark)
        jobs.batch_main(spark)
    finally:
        spark.conf.unset("spark.app.db")
    got = _bag(spark.read.table("cf_test.domain_edit_counts"))
    assert got == _bag(queries.domain_edit_counts(spark, SF_SMOKE))


def test_batch_bytes_scales_with_cluster(spark):
    from changefeed.streaming import batch_bytes
    from changefeed.streaming.triggers import _to_bytes

    assert _to_bytes("128m") == 128 << 20
    assert _to_bytes("1g") == 1 << 30
    assert _to_bytes("4096") == 4096
    from changefeed.session import parallelism

    assert int(batch_bytes(spark, waves=1)) == parallelism(spark) * _to_bytes(
        spark.conf.get("spark.sql.files.maxPartitionBytes", "128m"))


def test_listener_receives_every_batch(spark):
    import time as _t

    from changefeed.streaming import BatchRowsListener

    listener = BatchRowsListener("changes")
    spark.streams.addListener(listener)
    try:
        bed = queries._StreamBed(spark, "t-listener", files_per_trigger=2)
        bed.land(queries._lines(spark, SF_SMOKE))
        bed.run()
        deadline = _t.time() + 30
        while sum(n for _, _, n in listener.rows) < bed.table().count() and _t.time() < deadline:
            _t.sleep(0.5)  # listener events are delivered asynchronously
    finally:
        spark.streams.removeListener(listener)
    assert len(listener.rows) > 1
    assert sum(n for _, _, n in listener.rows) == bed.table().count()


def test_preview_stream_runs(spark):
    from changefeed.streaming import preview_stream

    base = shared_dir(spark, "t-preview")
    queries._lines(spark, SF_SMOKE).write.text(f"{base}/landing")
    records = jobs.ingest(spark.readStream.text(f"{base}/landing"))
    q = preview_stream(jobs.changes(records, "UTC"), 5, trigger="available_now",
                       checkpoint=f"{base}/_ckpt")
    run_bounded(q)
    assert q.lastProgress["numInputRows"] > 0


def test_stop_mid_run_then_resume_is_exactly_once(spark):
    import time as _t

    from changefeed.sinks import append_stream
    from changefeed.sources import feed_lines

    base = shared_dir(spark, "t-interrupt")
    lines_df = queries._lines(spark, SF_SMOKE)
    lines_df.repartition(12).write.text(f"{base}/landing")  # 12 files, one per batch below

    def start(trigger):
        lines = feed_lines(spark, f"{base}/landing", streaming=True, max_files_per_trigger=1)
        return append_stream(jobs.changes(jobs.ingest(lines), "UTC"), f"{base}/_ckpt",
                             path=f"{base}/out", trigger=trigger)

    q = start("0 seconds")
    _t.sleep(3)
    q.stop()  # may interrupt a batch between its write and its commit
    partial = spark.read.parquet(f"{base}/out").count() if q.lastProgress else 0
    run_bounded(start("available_now"))
    whole = queries.changes_flat(spark, SF_SMOKE)
    assert partial <= whole.count()
    assert _bag(spark.read.parquet(f"{base}/out")) == _bag(whole)

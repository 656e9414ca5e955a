"""Rows that once went missing without an error."""

import os
import time

import pytest

from changefeed.plans import jobs
from changefeed.session import shared_dir
from changefeed.streaming import run_bounded


def _line(i, extra=""):
    return 'data: {"id":%d,"meta":{"domain":"d%d.example.org"}%s}' % (i, i, extra)


def _land(folder, name, lines, days_old=0):
    path = f"{folder.removeprefix('file:')}/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")
    then = time.time() - days_old * 86400
    os.utime(path, (then, then))


def test_a_late_file_with_an_old_time_is_read(spark):
    base = shared_dir(spark, "t-late")
    for name, i, days in (("a.txt", 1, 0), ("b.txt", 2, 8), ("c.txt", 3, 0)):
        _land(f"{base}/landing", name, [_line(i)], days)
        run_bounded(jobs.stream_ingest(spark, f"{base}/landing", f"{base}/_ckpt",
                                       records_path=f"{base}/out", trigger="available_now"))
    assert sorted(r["key"] for r in spark.read.parquet(f"{base}/out").collect()) == [
        "d1.example.org", "d2.example.org", "d3.example.org"]


def test_a_new_checkpoint_keeps_earlier_batches(spark):
    from changefeed.sinks import append_batches
    from changefeed.sources import feed_lines

    base = shared_dir(spark, "t-owner")
    for n, lines in enumerate([[_line(1), _line(2), _line(3)], [_line(4)]]):
        _land(f"{base}/landing{n}", "a.txt", lines)
        df = jobs.changes(jobs.ingest(feed_lines(spark, f"{base}/landing{n}", streaming=True)), "UTC")
        run_bounded(append_batches(df, f"{base}/_ckpt{n}", f"{base}/out", trigger="available_now"))
    assert spark.read.parquet(f"{base}/out").count() == 4


def test_a_long_number_is_valid_json(spark, lines_df):
    got = jobs.ingest(lines_df([_line(1, ',"n":' + "9" * 1500)])).collect()
    assert [r["key"] for r in got] == ["d1.example.org"]


def test_quarantine_needs_a_target(spark):
    with pytest.raises(ValueError, match="quarantine_path"):
        jobs.stream_changes(spark, "unused", source_path="unused", path="unused", on_malformed="quarantine")


def test_total_covers_more_batches_than_the_progress_list(spark):
    from changefeed.streaming import BatchRowsListener, batch_rows

    base = shared_dir(spark, "t-total")
    for i in range(6):
        _land(f"{base}/landing", f"{i}.txt", [_line(2 * i), _line(2 * i + 1)])
    run_bounded(jobs.stream_ingest(spark, f"{base}/landing", f"{base}/_ci", records_path=f"{base}/records",
                                   trigger="available_now", max_files_per_trigger=1))
    counts = BatchRowsListener(jobs.CHANGES_METRIC, keep=2)
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    spark.streams.addListener(counts)
    try:
        q, = jobs.stream_changes(spark, f"{base}/_cc", source_path=f"{base}/records", path=f"{base}/out",
                                 trigger="available_now", max_files_per_trigger=1)
        run_bounded(q)
        assert counts.total(q) == spark.read.parquet(f"{base}/out").count() == 12
        assert sum(n for _, n in batch_rows(q)) < 12
    finally:
        spark.streams.removeListener(counts)
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)

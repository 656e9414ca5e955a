"""Sources, sinks and run control."""

import time

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMOKE

from changefeed import EVENT_SCHEMA, operators as ops
from changefeed.plans import jobs, queries
from changefeed.session import shared_dir
from changefeed.sinks import append_stream, overwrite, write_records
from changefeed.sources import feed_lines, json_events, read_records, table
from changefeed.streaming import apply_trigger, run_bounded


def test_json_events_batch_matches_parse(spark):
    base = shared_dir(spark, "t-json")
    framed = ops.well_formed(ops.frame(queries._lines(spark, SF_SMOKE)))
    framed.select(F.col("payload").alias("value")).write.text(f"{base}/json")
    scanned = json_events(spark, f"{base}/json")
    assert scanned.schema == EVENT_SCHEMA
    a = sorted(map(tuple, ops.flatten(scanned, "UTC").collect()), key=str)
    b = sorted(map(tuple, ops.flatten(ops.parse(framed), "UTC").collect()), key=str)
    assert a == b


def test_json_events_stream(spark):
    base = shared_dir(spark, "t-json-stream")
    spark.createDataFrame([('{"id":1}',), ('{"id":2}',)], "value string").write.text(f"{base}/in")
    q = (json_events(spark, f"{base}/in", streaming=True).writeStream.format("memory")
         .queryName("json_events_t").trigger(availableNow=True).start())
    run_bounded(q)
    assert sorted(r["id"] for r in spark.table("json_events_t").collect()) == [1, 2]


def test_records_roundtrip_and_table_scan(spark):
    base = shared_dir(spark, "t-records")
    recs = jobs.ingest(queries._lines(spark, SF_SMOKE))
    write_records(recs, path=f"{base}/records")
    back = read_records(spark, path=f"{base}/records")
    assert back.schema.simpleString() == "struct<key:string,value:binary>"
    assert back.count() == recs.count()
    with pytest.raises(ValueError):
        table(spark)
    assert table(spark, path=f"{base}/records").count() == recs.count()


def test_overwrite_replaces(spark):
    base = shared_dir(spark, "t-overwrite")
    overwrite(spark.range(5), path=f"{base}/t")
    overwrite(spark.range(2), path=f"{base}/t")
    assert spark.read.parquet(f"{base}/t").count() == 2
    with pytest.raises(ValueError):
        overwrite(spark.range(1))


def test_bounded_run_stops_a_fixed_interval_query(spark):
    base = shared_dir(spark, "t-bounded")
    spark.createDataFrame([("data: {}",)], "value string").write.text(f"{base}/in")
    lines = feed_lines(spark, f"{base}/in", streaming=True)
    q = append_stream(jobs.ingest(lines), f"{base}/_ckpt", path=f"{base}/out", trigger="1 second")
    deadline = time.time() + 120
    while not (q.lastProgress and q.lastProgress["numInputRows"]) and time.time() < deadline:
        time.sleep(0.5)  # wait for the first batch, however slow the machine
    t0 = time.time()
    run_bounded(q, 3)
    assert not q.isActive
    assert time.time() - t0 < 60
    assert spark.read.parquet(f"{base}/out").count() == 1


def test_apply_trigger_kinds(spark):
    df = spark.readStream.format("rate").load()
    for kind in (None, "available_now", "once", "10 seconds"):
        assert apply_trigger(df.writeStream, kind) is not None


def test_append_stream_needs_one_target(spark):
    df = spark.readStream.format("rate").load()
    with pytest.raises(ValueError):
        append_stream(df, "/nonexistent/ckpt")


def test_append_batches_is_idempotent_per_batch(spark):
    from changefeed.sinks import append_batches

    base = shared_dir(spark, "t-batches")
    queries._lines(spark, SF_SMOKE).write.text(f"{base}/landing")
    lines = feed_lines(spark, f"{base}/landing", streaming=True)
    q = append_batches(jobs.changes(jobs.ingest(lines), "UTC"), f"{base}/_ckpt", f"{base}/out",
                       trigger="available_now")
    run_bounded(q)
    out = spark.read.parquet(f"{base}/out")
    n = out.count()
    assert n == queries.changes_flat(spark, SF_SMOKE).count()
    # a replayed batch (failure between its write and its commit) rewrites its own folder
    from changefeed.sinks.tables import batch_writer

    owner = spark.read.parquet(f"{base}/out").first()["query_id"]
    out = f"{base}/out/query_id={owner}"
    write = batch_writer(out)
    first = spark.read.parquet(f"{out}/batch_id=0")
    batch0 = spark.createDataFrame(first.collect(), first.schema)  # the batch as recomputed
    write(batch0, 0)
    write(batch0, 0)
    assert spark.read.parquet(f"{base}/out").count() == n


def test_json_events_array_and_blank_lines(spark, tmp_path):
    path = tmp_path / "events.json"
    path.write_text('[{"id":1},{"id":2}]\n\n{"id":3}\n')
    ids = sorted(r["id"] for r in json_events(spark, str(path)).collect())
    assert ids == [1, 2, 3]  # an array gives one row per element; a blank line none


def test_append_stream_bounds_files_per_batch(spark):
    import glob

    base = shared_dir(spark, "t-files")
    queries._lines(spark, SF_SMOKE).repartition(6).write.text(f"{base}/landing")
    lines = feed_lines(spark, f"{base}/landing", streaming=True, max_files_per_trigger=3)
    q = append_stream(jobs.ingest(lines), f"{base}/_ckpt", path=f"{base}/out",
                      trigger="available_now", partitions=1)
    run_bounded(q)
    written = glob.glob(f"{base}/out/*.parquet")
    assert len(written) == 2  # two batches, one file each
    assert spark.read.parquet(f"{base}/out").count() == jobs.ingest(
        spark.read.text(f"{base}/landing")).count()

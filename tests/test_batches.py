"""One batch with several outputs, published summaries, counts by commit, tip
starts, feed order, bounded stops and long allow-lists."""

import glob
import os
import threading
import time
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMOKE

from changefeed import operators as ops
from changefeed.plans import incremental, jobs, queries
from changefeed.session import shared_dir
from changefeed.sinks import Output, append_outputs, overwrite, publish, read_batches, read_metrics, runs
from changefeed.sinks.publish import current, remove
from changefeed.sources import feed_lines, read_records, table
from changefeed.streaming import run_bounded, start_at_tip, stop_at_batch_end


def _local(path):
    return path.removeprefix("file:")


def _land(base, name, lines):
    path = f"{_local(base)}/landing/{name}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(lines) + "\n")


def _line(i, domain="a.example.org"):
    return 'data: {"id":%d,"meta":{"domain":"%s"}}' % (i, domain)


BAD = ["data: {broken", "data: [1]", ':ok', 'data: {"meta":1}']


class _Killed(Exception):
    pass


def test_a_kill_between_the_two_writes_loses_and_repeats_nothing(spark):
    base = shared_dir(spark, "t-kill")
    for n in range(3):
        _land(base, f"{n}.txt", [_line(10 * n + i) for i in range(5)] + BAD)
    lines = feed_lines(spark, f"{base}/landing", streaming=True, max_files_per_trigger=1)
    calls = []

    def rejects(batch):
        calls.append(1)
        if len(calls) == 2:  # the second batch's records are written, its rejects are not
            raise _Killed("between the writes")
        return batch.where("reason IS NOT NULL").select("payload", "reason")

    def start():
        return append_outputs(
            ops.classify(ops.frame(lines)), f"{base}/_ckpt",
            [Output("records", lambda b: ops.keyed(b.where("reason IS NULL")), path=f"{base}/records"),
             Output("rejects", rejects, path=f"{base}/rejects")],
            trigger="available_now", metrics_path=f"{base}/metrics")

    with pytest.raises(Exception, match="between the writes"):
        run_bounded(start())
    assert read_batches(spark, f"{base}/records").count() == 10
    assert read_batches(spark, f"{base}/rejects").count() == 3
    run_bounded(start())
    kept, bad = (read_batches(spark, f"{base}/{x}").count() for x in ("records", "rejects"))
    assert (kept, bad) == (15, 9)
    counts = read_metrics(spark, f"{base}/metrics").groupBy("output").agg(F.sum("n_rows").alias("n"))
    assert {r["output"]: r["n"] for r in counts.collect()} == {"records": 15, "rejects": 9}
    assert read_metrics(spark, f"{base}/metrics").count() == 6


def test_cleaned_sources_lose_no_rejects(spark):
    base = shared_dir(spark, "t-clean")
    for n in range(4):
        _land(base, f"{n}.txt", [_line(n)] + BAD[:1])
    for _ in range(2):
        run_bounded(jobs.stream_ingest(
            spark, f"{base}/landing", f"{base}/_ckpt", records_path=f"{base}/records", rejects_path=f"{base}/rejects",
            trigger="available_now", max_files_per_trigger=1, source_options={"cleanSource": "delete"}))
    assert read_batches(spark, f"{base}/records").count() == 4
    assert read_batches(spark, f"{base}/rejects").count() == 4


def test_outputs_to_a_table_and_to_files(spark):
    base = shared_dir(spark, "t-table")
    name = "t_outputs_" + base.rsplit("-", 1)[1]
    _land(base, "a.txt", [_line(1), "data: {x"])
    framed = ops.frame(feed_lines(spark, f"{base}/landing"))
    records = framed.select(F.lit("k").alias("key"), F.col("payload").cast("binary").alias("value"))
    try:
        for n in (1, 2):
            records.write.mode("append").parquet(f"{base}/records")
            q, = jobs.stream_changes(spark, f"{base}/_ckpt", source_path=f"{base}/records", table=name,
                                     trigger="available_now", time_zone="UTC", on_malformed="quarantine",
                                     quarantine_path=f"{base}/bad")
            run_bounded(q)
            rows = spark.read.table(name)
            assert rows.count() == n and rows.select("batch_id").distinct().count() == n
            assert read_batches(spark, f"{base}/bad").count() == n
        rows = spark.read.table(name).where("batch_id = 1")
        out = Output("again", lambda b: b, table=name)  # a replayed batch replaces its own rows only
        out.write(spark.createDataFrame(rows.drop("query_id", "batch_id").collect(),
                                        rows.drop("query_id", "batch_id").schema), rows.first()["query_id"], 1)
        assert spark.read.table(name).count() == 2
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_outputs_need_names_and_targets():
    with pytest.raises(ValueError, match="path or table"):
        Output("x", lambda b: b)
    with pytest.raises(ValueError, match="names"):
        append_outputs(None, "c", [Output("x", lambda b: b, path="p")] * 2)


def test_sample_is_of_the_batch_and_takes_one_job(spark):
    base = shared_dir(spark, "t-sample")
    for n in range(3):
        _land(base, f"{n}.txt", [_line(10 * n + i) for i in range(2 + 6 * (n > 0))])
    reports = []
    lines = feed_lines(spark, f"{base}/landing", streaming=True, max_files_per_trigger=1)
    q = append_outputs(jobs.ingest(lines), f"{base}/_ckpt", [Output("r", lambda b: b, path=f"{base}/r")],
                       trigger="available_now", sample=5, on_batch=reports.append)
    run_bounded(q)
    assert sorted((r.counts["r"], len(r.sample)) for r in reports) == [(2, 2), (8, 5), (8, 5)]
    written = read_batches(spark, f"{base}/r", keep_ids=True).collect()
    for r in reports:
        own = {bytes(x["value"]) for x in written if x["batch_id"] == r.batch_id}
        assert {bytes(x["value"]) for x in r.sample} <= own
    jobs_of = spark.sparkContext.statusTracker().getJobIdsForGroup(str(q.runId))
    assert len(jobs_of) <= 3 + 1  # a write a batch, and the checkpoint's metadata once


def test_readers_see_the_old_summary_or_the_new_one(spark):
    base = shared_dir(spark, "t-publish")
    name = "t_published_" + base.rsplit("-", 1)[1]
    frames = [spark.range(100).select(F.lit(v).alias("v")) for v in range(6)]
    publish(frames[0], f"{base}/p")
    publish(frames[0], f"{base}/t", table=name)
    seen, stop, errors = defaultdict(set), threading.Event(), []

    def read():
        while not stop.is_set():
            try:
                for kind, df in (("path", table(spark, path=f"{base}/p")), ("table", spark.read.table(name))):
                    seen[kind].add(tuple(sorted({(r["v"], r["n"]) for r in df.groupBy("v").agg(
                        F.count("*").alias("n")).collect()})))
            except Exception as exc:
                errors.append(exc)
                return

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for df in frames[1:]:
            publish(df, f"{base}/p", keep=10)
            publish(df, f"{base}/t", table=name, keep=10)
            time.sleep(0.3)
    finally:
        stop.set()
        reader.join()
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert not errors
    for kind in ("path", "table"):
        assert len(seen[kind]) > 1 and all(len(x) == 1 and x[0][1] == 100 for x in seen[kind])


def test_a_run_that_did_not_end_is_not_shown(spark):
    base = shared_dir(spark, "t-half")
    for v in (1, 2, 3):
        overwrite(spark.range(v).toDF("v"), path=f"{base}/s", atomic=True)
    assert len(runs(spark, f"{base}/s")) == 2  # older ones are gone
    spark.range(9).toDF("v").write.parquet(f"{base}/s/_runs/run-{10 ** 9:012d}-half")
    remove(spark, f"{base}/s/_runs/run-{10 ** 9:012d}-half/_SUCCESS")
    assert table(spark, path=f"{base}/s").count() == 3
    overwrite(spark.range(4).toDF("v"), path=f"{base}/s", atomic=True)
    assert table(spark, path=f"{base}/s").count() == 4 and current(spark, f"{base}/s") != f"{base}/s"
    overwrite(spark.range(5).toDF("v"), path=f"{base}/plain")
    assert table(spark, path=f"{base}/plain").count() == 5


def test_counts_by_commit_equal_a_full_count(spark):
    base = shared_dir(spark, "t-commits")
    src, partials = f"{base}/changes", f"{base}/partials"

    def run(lines):
        _land(base, f"{time.time_ns()}.txt", lines)
        framed = jobs.ingest(feed_lines(spark, f"{base}/landing", streaming=True, max_files_per_trigger=1))
        run_bounded(append_outputs(jobs.changes(framed, "UTC"), f"{base}/_ckpt", [Output("c", lambda b: b, path=src)],
                                   trigger="available_now"))

    def same():
        got = Counter({r["domain"]: r["edit_count"] for r in incremental.summary(spark, partials).collect()})
        want = Counter({r["domain"]: r["edit_count"] for r in ops.domain_counts(read_batches(spark, src)).collect()})
        return got == want

    assert incremental.refresh(spark, src, partials) == 0 and incremental.summary(spark, partials).count() == 0
    run([_line(i, f"d{i % 3}") for i in range(20)] + ['data: {"id":7}'])
    assert incremental.refresh(spark, src, partials) == 1 and same()
    assert incremental.refresh(spark, src, partials) == 0 and same()
    run([_line(i, f"d{i % 5}") for i in range(30)])
    run([_line(i, "d9") for i in range(3)])
    assert incremental.refresh(spark, src, partials) == 2 and same()  # two commits are read, not three
    lost = sorted(glob.glob(f"{_local(partials)}/query_id=*/batch_id=1"))
    remove(spark, lost[0])
    assert not same()
    assert incremental.refresh(spark, src, partials) == 1 and same()
    jobs.domain_edit_counts(spark, src_path=src, dst_path=f"{base}/summary", partials_path=partials)
    assert table(spark, path=f"{base}/summary").agg(F.sum("edit_count")).first()[0] == 54


def test_tip_start_reads_only_what_lands_later(spark):
    base = shared_dir(spark, "t-tip")
    _land(base, "old.txt", [_line(1), _line(2)])

    def run():
        run_bounded(jobs.stream_ingest(spark, f"{base}/landing", f"{base}/_ckpt", records_path=f"{base}/records",
                                       trigger="available_now", from_tip=True))

    run()
    assert not glob.glob(f"{_local(base)}/records/*/*/*.parquet")
    _land(base, "new.txt", [_line(3)])
    run()
    _land(base, "newer.txt", [_line(4)])
    run()
    run()
    got = sorted(bytes(r["value"]).decode() for r in read_records(spark, path=f"{base}/records").collect())
    assert [x[6] for x in got] == ["3", "4"]
    assert start_at_tip(feed_lines(spark, f"{base}/landing", streaming=True), f"{base}/_ckpt") is False


def test_records_of_a_key_come_back_in_feed_order(spark):
    base = shared_dir(spark, "t-order")
    n, want = 0, defaultdict(list)
    for f in range(6):
        lines = []
        for _ in range(200):
            key = "hot" if n % 3 else f"k{n % 7}"
            lines += [_line(n, key)] + (BAD[:1] if n % 11 == 0 else [])
            want[key].append(n)
            n += 1
        _land(base, f"{f}.txt", lines)
        then = 1_600_000_000 + f
        os.utime(f"{_local(base)}/landing/{f}.txt", (then, then))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # several splits a file
    try:
        run_bounded(jobs.stream_ingest(spark, f"{base}/landing", f"{base}/_ckpt", records_path=f"{base}/records",
                                       rejects_path=f"{base}/rejects", trigger="available_now", ordered=True,
                                       max_files_per_trigger=4))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    got = defaultdict(list)
    for r in jobs.records_in_order(spark, f"{base}/records").collect():
        got[r["key"]].append(int(bytes(r["value"]).decode().split(":")[1].split(",")[0]))
    assert got == want
    assert len(glob.glob(f"{_local(base)}/records/*/*/*.parquet")) > 2


def test_stop_between_batches_leaves_none_half_done(spark):
    base = shared_dir(spark, "t-stop")
    for n in range(40):
        _land(base, f"{n}.txt", [_line(n)])
    q = jobs.stream_ingest(spark, f"{base}/landing", f"{base}/_ckpt", records_path=f"{base}/records",
                           trigger="400 milliseconds", max_files_per_trigger=1)
    run_bounded(q, 4, batch_end_seconds=30)
    assert not q.isActive

    def numbers(log):
        return {int(os.path.basename(p)) for p in glob.glob(f"{_local(base)}/_ckpt/{log}/[0-9]*")}

    assert numbers("offsets") == numbers("commits") != set()
    assert stop_at_batch_end(q) is True


def test_a_long_allow_list_gives_the_rows_of_no_pretest(spark, lines_df):
    domains = [f"d{i}.example.org" for i in range(5000)] + ["a/b", 'q"x']
    lines = [_line(i, f"d{i * 37 % 9000}.example.org") for i in range(400)]
    lines += ['data: {"id":1,"meta" : { "domain" :\t"d7.example.org"}}', 'data: {"id":2,"meta":{"domain":"\\u0064" }}',
              'data: {"id":3,"meta":{"dom\\u0061in":"d1.example.org"}}', 'data: {"id":4,"meta":{"domain":"\\u00641.example.org"}}',
              'data: {"id":5,"meta":{"domain":"a\\/b"}}', 'data: {"id":6,"meta":{"domain":"q\\"x"}}',
              'data: {"id":7,"domain":"d1.example.org","meta":{"domain":"none"}}', *BAD]
    df = lines_df(lines)
    fast = Counter(bytes(r["value"]) for r in jobs.ingest(df, domains).collect())
    slow = Counter(bytes(r["value"]) for r in jobs.ingest(df, domains, pretest=False).collect())
    assert fast == slow and sum(fast.values()) > 200
    few = domains[:10]
    assert (Counter(bytes(r["value"]) for r in jobs.ingest(df, few).collect())
            == Counter(bytes(r["value"]) for r in jobs.ingest(df, few, pretest=False).collect()))


def test_pretest_of_a_long_list_saves_the_parse(spark):
    lines = queries._lines(spark, SF_SMOKE)
    allowed = [f"x{i}.example.org" for i in range(5000)] + ["click.example.org"]
    want = jobs.ingest(lines, ["click.example.org"], pretest=False).count()
    assert jobs.ingest(lines, allowed).count() == want > 0


def test_files_keep_their_size_while_the_feed_changes_tenfold(spark):
    base = shared_dir(spark, "t-sizes")
    target = 20_000
    for n, rows in enumerate([2000, 2000, 20000, 2000, 20000]):
        _land(base, f"{n}.txt", [_line(i, f"h{hash((n, i))}.example.org") for i in range(rows)])
        then = 1_600_000_000 + n
        os.utime(f"{_local(base)}/landing/{n}.txt", (then, then))
    lines = feed_lines(spark, f"{base}/landing", streaming=True, max_files_per_trigger=1)
    run_bounded(append_outputs(jobs.ingest(lines), f"{base}/_ckpt",
                               [Output("r", lambda b: b, path=f"{base}/r", target_file_bytes=target)],
                               trigger="available_now"))
    assert read_batches(spark, f"{base}/r").count() == 46000
    for batch in range(1, 5):
        sizes = [os.path.getsize(p) for p in glob.glob(f"{_local(base)}/r/*/batch_id={batch}/*.parquet")]
        assert target / 2 <= sum(sizes) / len(sizes) <= 2 * target, (batch, sizes)
    with pytest.raises(ValueError, match="plain files"):
        Output("x", lambda b: b, table="t", target_file_bytes=1)

"""spark-submit entry points driven by spark.app.* settings."""

from collections import Counter

from conftest import SF_SMOKE

from changefeed.plans import jobs, queries
from changefeed.session import shared_dir


def _with_conf(spark, conf, fn):
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        fn(spark)
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_ingest_then_streaming_mains(spark):
    base = shared_dir(spark, "t-mains")
    queries._lines(spark, SF_SMOKE).write.text(f"{base}/landing")
    _with_conf(spark, {
        "spark.app.linesPath": f"{base}/landing",
        "spark.app.checkpoint": f"{base}/_ckpt_ingest",
        "spark.app.sinkFormat": "parquet",
        "spark.app.recordsPath": f"{base}/records",
        "spark.app.trigger": "available_now",
        "spark.app.domains": "click.example.org, view.example.org",
        "spark.app.rejectsPath": f"{base}/rejects",
        "spark.app.rejectsCheckpoint": f"{base}/_ckpt_rejects",
    }, jobs.ingest_main)
    keys = Counter(r["key"] for r in spark.read.parquet(f"{base}/records").collect())
    assert set(keys) == {"click.example.org", "view.example.org"}
    rejects = spark.read.parquet(f"{base}/rejects")
    assert rejects.count() == jobs.ingest_rejects(spark.read.text(f"{base}/landing")).count() > 0

    spark.sql("CREATE DATABASE IF NOT EXISTS cf_mains")
    _with_conf(spark, {
        "spark.app.sourceFormat": "parquet",
        "spark.app.sourcePath": f"{base}/records",
        "spark.app.checkpoint": f"{base}/_ckpt_changes",
        "spark.app.db": "cf_mains",
        "spark.app.trigger": "available_now",
    }, jobs.streaming_main)
    flat = spark.read.table("cf_mains.recent_changes_stream")
    assert flat.count() == sum(keys.values())
    assert flat.columns[:2] == ["event_id", "event_type"]


def test_table_names_from_settings(spark):
    from changefeed.plans.jobs import _table_name

    assert _table_name(spark, "t") == "t"
    spark.conf.set("spark.app.db", "d")
    try:
        assert _table_name(spark, "t") == "d.t"
        spark.conf.set("spark.app.catalog", "c")
        assert _table_name(spark, "t") == "c.d.t"
    finally:
        spark.conf.unset("spark.app.db")
        spark.conf.unset("spark.app.catalog")

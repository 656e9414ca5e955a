"""A domain holding a third of all events: counts stay exact, and the plan
aggregates map-side so the hot key ships one row per task."""

from pyspark.sql import functions as F

from conftest import SF_CHECK
from test_plans import plan

from changefeed import operators as ops
from changefeed.plans import jobs
from changefeed.sources import render_feed


def test_hot_domain_counts(spark, duck_check):
    events = spark.read.parquet(f"{SF_CHECK}/events.parquet")
    hot = events.withColumn("event_type", F.when(F.col("event_id") % 3 == 0, F.lit("hot"))
                            .otherwise(F.col("event_type")))
    counts = jobs.summarize(jobs.changes(jobs.ingest(render_feed(ops.spread(hot))), "UTC"))
    got = {r["domain"]: r["edit_count"] for r in counts.collect()}
    expected = dict(duck_check.execute("""
        SELECT CASE WHEN event_id % 71 <> 0 THEN
                    (CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE event_type END) || '.example.org' END,
               count(*)
        FROM events
        WHERE event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 83 <> 0
          AND event_id % 79 <> 0 AND event_id % 73 <> 0
        GROUP BY 1""").fetchall())
    assert got == expected
    assert got["hot.example.org"] > sum(got.values()) / 4

    text = plan(counts)
    partial = text.index("partial_count")
    exchange = text.index("hashpartitioning(domain")
    # partial aggregate sits below (is listed after, in operator order) the hash exchange
    assert "HashAggregate" in text and partial > 0 and exchange > 0
    final_tree = text.split("\n\n")[0].split("== Initial Plan ==")[0]
    assert final_tree.count("HashAggregate") == 2

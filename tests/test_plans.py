"""Plan checks: JVM-only, parse once, partial aggregation, pruned scans."""

import io
import re
from contextlib import redirect_stdout

import pytest

from conftest import SF_CHECK

from changefeed.plans import queries

BATCH_QUERIES = ["feed_data_lines", "ingest_valid", "ingest_allowlist", "ingest_keyed",
                 "ingest_rejects", "changes_flat", "domain_edit_counts", "page_domain_counts",
                 "source_domain_counts", "parse_permissive_nulls", "parse_quarantine_kept",
                 "parse_quarantine_rejected", "preview_rows"]
assert set(BATCH_QUERIES) <= set(queries.QUERIES)


def plan(df, mode="formatted"):
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.mark.parametrize("name", BATCH_QUERIES)
def test_no_python_in_plan(spark, name):
    text = plan(queries.QUERIES[name](spark, SF_CHECK))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas",
                 "PythonUDF", "MapPartitions"):
        assert node not in text


def _operator_lines(text):
    # the tree at the top of a formatted plan
    return text.split("\n\n")[0]


def test_payload_parsed_once_in_ingest(spark):
    text = plan(queries.ingest_keyed(spark, SF_CHECK))
    tree = _operator_lines(text)
    assert tree.count("Generate") >= 2
    # the map parse over the payload appears in exactly one operator
    details = [blk for blk in text.split("\n\n") if "from_json(ArrayType" in blk and "payload" in blk]
    parse_ops = [d for d in details
                 if re.search(r"from_json\(ArrayType\(MapType\(StringType,StringType,true\),true\), (\([^)]*\), )+concat\(\[, payload#", d)]
    assert len(parse_ops) == 1, parse_ops


def test_partial_aggregation_before_shuffle(spark):
    text = plan(queries.domain_edit_counts(spark, SF_CHECK))
    assert "partial_count" in text
    assert "hashpartitioning(domain" in text
    assert "SinglePartition" not in text


@pytest.mark.parametrize("name,schema", [
    ("source_domain_counts", "struct<source:string>"),
    ("page_domain_counts", "struct<url:string>"),
])
def test_scan_reads_only_needed_columns(spark, name, schema):
    assert f"ReadSchema: {schema}" in plan(queries.QUERIES[name](spark, SF_CHECK))


def test_frame_filter_pushed_to_text_scan(spark, tmp_path):
    from changefeed import operators as ops

    (tmp_path / "f.txt").write_text("data: {}\n:ok\n")
    text = plan(ops.frame(spark.read.text(str(tmp_path))))
    assert "PushedFilters: [IsNotNull(value), StringStartsWith(value,data: )]" in text


def test_spread_only_when_under_split(spark):
    from changefeed import operators as ops

    small = spark.read.parquet(f"{SF_CHECK}/events.parquet")
    assert small.rdd.getNumPartitions() == 1
    spread = ops.spread(small, 8)
    assert spread.rdd.getNumPartitions() == 8
    assert spread.count() == small.count()
    wide = spark.range(0, 1000, 1, 16)
    assert ops.spread(wide, 8) is wide
    stream = spark.readStream.format("rate").load()
    assert ops.spread(stream) is stream


def test_summary_job_reads_only_domain(spark):
    from changefeed.plans import jobs
    from changefeed.session import shared_dir
    from changefeed.sources import table

    base = shared_dir(spark, "t-prune")
    queries.changes_flat(spark, SF_CHECK).write.parquet(f"{base}/changes")
    text = plan(jobs.summarize(table(spark, path=f"{base}/changes")))
    assert "ReadSchema: struct<domain:string>" in text


def test_summary_parses_only_the_domain(spark):
    text = plan(queries.domain_edit_counts(spark, SF_CHECK))
    assert "from_json(StructField(meta,StructType(StructField(domain,StringType,true)),true)" in text
    assert not re.search(r"from_json\(StructField\(meta[^#]*server_name", text)


def test_library_has_no_slow_path_constructs():
    """The change-feed library (not the optional llm operators): no Python UDFs, pandas paths, driver collects, broadcasts, cross joins or
    local checkpoints anywhere in the library; `.rdd` only to read a partition count."""
    import pathlib

    root = pathlib.Path(__file__).resolve().parent.parent / "changefeed"
    banned = ["udf(", "pandas_udf", "mapInPandas", "applyInPandas", "toPandas", ".collect()",
              "broadcast(", "crossJoin", "localCheckpoint", "mapPartitions"]
    for path in root.rglob("*.py"):
        if "llm" in path.relative_to(root).parts:
            continue
        text = path.read_text()
        for word in banned:
            assert word not in text, f"{word} in {path}"
        for line in text.splitlines():
            if ".rdd" in line:
                assert ".rdd.getNumPartitions()" in line, f"{path}: {line}"


def test_time_string_uses_cheap_path_when_zones_match(spark):
    from changefeed import operators as ops

    df = ops.parse(spark.createDataFrame([('{"timestamp":0}',)], "payload string"))
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        same = plan(ops.flatten(df, "UTC"), "extended")
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        other = plan(ops.flatten(df, "UTC"), "extended")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert "from_unixtime" in same and "convert_timezone" not in same
    assert "convert_timezone" in other

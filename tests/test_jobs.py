"""Daily summary job: idempotent overwrite, distinct source and target."""

import pytest

from conftest import SF_SMOKE

from changefeed.plans import jobs, queries
from changefeed.session import shared_dir


def test_summary_twice_is_one_copy(spark):
    got = queries.summary_overwrite_twice(spark, SF_SMOKE).collect()
    expected = queries.domain_edit_counts(spark, SF_SMOKE).collect()
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_summary_refuses_same_source_and_target(spark):
    path = shared_dir(spark, "t-same")
    with pytest.raises(ValueError):
        jobs.domain_edit_counts(spark, src_path=path, dst_path=path)


def test_shared_dir_is_fresh_and_under_checkpoint_root(spark):
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a != b
    conf_root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    root = (conf_root or spark.sparkContext.getCheckpointDir()).rstrip("/")
    assert a.startswith(root + "/changefeed/")

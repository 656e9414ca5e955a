"""Partition-count guard for CPU-heavy narrow work."""

from __future__ import annotations

from pyspark.sql import DataFrame

from changefeed.session import parallelism


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over ``min_partitions`` (default: the cluster's
    parallelism) when it arrives in fewer partitions than that.

    A single unsplittable file (one Parquet row group, one gzip file) is
    read by one task, and the JSON render/parse after it would run on one
    core.  A large input already has many more splits than cores and is
    returned unchanged, so this adds a shuffle only where the data is small
    enough for the shuffle to be cheap.
    """
    if df.isStreaming:
        return df  # a stream's splits are per micro-batch; nothing to check here
    target = min_partitions or parallelism(df.sparkSession)
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target)

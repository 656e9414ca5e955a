"""The daily summary by commits.

A table written batch by batch (``sinks.append_outputs`` or
``append_batches``) has one folder per (query id, batch id).  Counts are kept
per such commit: a refresh reads only commits that have no counts yet and
writes one small folder of counts for each; the summary adds the counts up.
A day's refresh reads a day, however long the table is.

Defined results: equal to a count of the whole table.  A commit without rows
counts as nothing; a refresh that was interrupted or whose counts were lost is
made up for by the next one; a commit is read once complete (its ``_SUCCESS``
mark).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.operators import ranked
from changefeed.sinks.publish import matching
from changefeed.sinks.tables import BATCH_COLUMN, QUERY_COLUMN

_COMMITS = f"{QUERY_COLUMN}=*/{BATCH_COLUMN}=*"


def _commit(path: str) -> str:
    """``query_id=.../batch_id=N`` of a path inside a commit's folder."""
    parts = path.split("/")
    at = max(i for i, p in enumerate(parts) if p.startswith(f"{QUERY_COLUMN}="))
    return "/".join(parts[at:at + 2])


def commits(spark: SparkSession, path: str) -> set[str]:
    """Complete commits of a table."""
    return {_commit(p) for p in matching(spark, f"{path.rstrip('/')}/{_COMMITS}/_SUCCESS")}


def new_commits(spark: SparkSession, src_path: str, partials_path: str) -> list[str]:
    """Commits of the table without counts."""
    counted = {_commit(p) for p in matching(spark, f"{partials_path.rstrip('/')}/{_COMMITS}")}
    return sorted(commits(spark, src_path) - counted)


def refresh(spark: SparkSession, src_path: str, partials_path: str, key: str = "domain",
            fmt: str = "parquet") -> int:
    """Count the commits that have no counts yet; returns how many they were."""
    new = new_commits(spark, src_path, partials_path)
    if new:
        rows = (spark.read.format(fmt).option("basePath", src_path)
                .load([f"{src_path.rstrip('/')}/{c}" for c in new]))
        ids = [QUERY_COLUMN, BATCH_COLUMN]
        counts = rows.groupBy(*ids, F.col(key).alias("domain")).agg(F.count(F.lit(1)).alias("n"))
        # One file per commit, put in place whole; other commits stay as they are.
        (counts.repartition(*[F.col(c) for c in ids]).write.partitionBy(*ids)
         .option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(partials_path))
    return len(new)


def summary(spark: SparkSession, partials_path: str) -> DataFrame:
    """Edits per domain over all counted commits, most first."""
    found = matching(spark, f"{partials_path.rstrip('/')}/{_COMMITS}")
    schema = f"domain string, n long, {QUERY_COLUMN} string, {BATCH_COLUMN} long"
    partials = spark.read.schema(schema).parquet(partials_path) if found else spark.createDataFrame([], schema)
    return ranked(partials.groupBy("domain").agg(F.sum("n").alias("edit_count")))

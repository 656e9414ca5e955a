"""Atomic replacement of a table's content.

Every run writes a folder of its own, ``_runs/run-<number>-<suffix>``; readers are
shown the run with the greatest number that is complete (Spark's ``_SUCCESS``
mark comes last).  A catalog table is switched to the new folder by its
location, one change in the catalog.  A reader during a run sees the old rows
until the new ones are whole, and one that has begun on the old run can end,
as earlier runs are removed only after ``keep`` newer ones.  A reader that scans
the path itself finds no rows there and fails, rather than see several runs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

RUN = "_runs/run-"


def _files(spark: SparkSession, path: str):
    """Hadoop's view of a folder: (file system, path)."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob pattern."""
    fs, at = _files(spark, pattern)
    return sorted(s.getPath().toString() for s in fs.globStatus(at) or ())


def size(spark: SparkSession, path: str) -> int:
    """Bytes of the data files in a folder (marks and check sums left out)."""
    fs, at = _files(spark, f"{path.rstrip('/')}/*")
    named = [(s.getPath().getName(), s.getLen()) for s in fs.globStatus(at) or ()]
    return sum(n for name, n in named if not name.startswith(("_", ".")))


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder."""
    fs, at = _files(spark, path)
    fs.delete(at, True)


def runs(spark: SparkSession, path: str) -> list[str]:
    """Complete runs, oldest first."""
    done = matching(spark, f"{path.rstrip('/')}/{RUN}*/_SUCCESS")
    return sorted(p.rsplit("/", 1)[0] for p in done)


def current(spark: SparkSession, path: str) -> str:
    """The folder that readers of ``path`` are shown: its newest complete run,
    or ``path`` itself if it has no runs (a table written in place)."""
    found = runs(spark, path)
    return found[-1] if found else path


def publish(df: DataFrame, path: str, *, table: str | None = None, fmt: str = "parquet", keep: int = 2) -> str:
    """Write ``df`` as a new run under ``path`` and show it; returns the run's
    folder.  With ``table`` the catalog table of that name is created at, or
    moved to, the new folder.  ``keep`` complete runs stay (2 at least)."""
    spark = df.sparkSession
    number = [int(p.rsplit(RUN, 1)[1].split("-")[0]) for p in matching(spark, f"{path.rstrip('/')}/{RUN}*")]
    run = f"{path.rstrip('/')}/{RUN}{max(number, default=0) + 1:012d}-{uuid.uuid4().hex[:8]}"
    df.write.format(fmt).save(run)
    if table is not None:
        if spark.catalog.tableExists(table):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{run}'")
            spark.catalog.refreshTable(table)
        else:
            spark.catalog.createTable(table, path=run, source=fmt)
    for old in runs(spark, path)[:-max(keep, 2)]:
        remove(spark, old)
    return run


def table_home(spark: SparkSession, table: str) -> str:
    """Where the runs of a catalog table go: beside its database's tables."""
    parts = table.split(".")
    database = ".".join(parts[:-1]) or spark.catalog.currentDatabase()
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/_runs_{parts[-1]}"

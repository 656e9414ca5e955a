"""Table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from changefeed.sinks.publish import current


def table(spark: SparkSession, ident: str | None = None, path: str | None = None,
          fmt: str = "parquet") -> DataFrame:
    """Full scan of a catalog table (``ident``) or of a table at ``path``.

    Column pruning and filter pushdown reach the file scan through Catalyst.
    Of a path that :func:`changefeed.sinks.publish` writes, the newest
    complete run is read.
    """
    if (ident is None) == (path is None):
        raise ValueError("give exactly one of ident or path")
    if ident is not None:
        return spark.read.table(ident)
    return spark.read.format(fmt).load(current(spark, path))

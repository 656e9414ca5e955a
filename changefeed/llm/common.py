"""Helpers the operators share."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changefeed.session import shared_dir

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
#: Rows that Spark and a Python worker hand each other at once.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(column: str = "text"):
    """The text, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text) -> "F.Column":
    """Array of the words of a text column, in order (empty array: none)."""
    return F.filter(F.split(text, SPACE), lambda w: w != F.lit(""))


def small(batches, rows: int = BATCH_ROWS):
    """The Arrow batches cut to at most ``rows`` rows, which bounds what a
    worker unpacks at once."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)


@contextmanager
def small_batches(spark: SparkSession, rows: int = BATCH_ROWS):
    """Inside, the session's queries hand Python ``rows`` rows at once at
    most: a batch of whole texts is held by the executor and by its worker."""
    before = spark.conf.get(_BATCH)
    if not 0 < int(before) <= rows:
        spark.conf.set(_BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read back.

    Cuts the lineage: a lost executor re-reads the files instead of
    recomputing what came before.
    """
    spark = df.sparkSession
    path = shared_dir(spark, f"llm-{name}")
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)

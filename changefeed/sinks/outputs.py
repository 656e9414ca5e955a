"""One micro-batch, several outputs.

A streaming query reads and parses its source once; every batch is split into
its outputs (records and rejects, table and quarantine) inside one
``foreachBatch`` step, so all outputs see the same rows and start and stop
together.  Each output writes the batch under its own (query id, batch id),
replacing what an earlier, interrupted attempt left there; the batch is
committed by the checkpoint only after the last of them.  A batch that is
replayed after a failure therefore leaves one copy in every output, and
together they hold the whole input.

The same step can record the batch's row counts in a table that outlives the
driver, and hand out a bounded sample of the rows it wrote; both come from
observed aggregates of the write itself, so no row is computed twice and no
second query reads the source.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changefeed.sinks.publish import size
from changefeed.sinks.tables import BATCH_COLUMN, QUERY_COLUMN, batch_writer
from changefeed.streaming.triggers import apply_trigger

METRICS_SCHEMA = f"{QUERY_COLUMN} string, {BATCH_COLUMN} long, output string, n_rows long"
_PLACE = "__place_in_task"
#: Bytes a row is taken for before the first batch is written.
FIRST_ROW_BYTES = 100


@dataclass(frozen=True)
class Output:
    """What of a batch goes where: ``rows`` maps the batch to the output's rows.

    ``path``: files under ``path/query_id=.../batch_id=N``; ``table``: a catalog
    table partitioned by the same two columns; ``fmt="kafka"``: a topic named
    in ``options`` (a replayed batch is sent again, as a topic has no batch to
    replace).  ``fmt="delta"`` uses the writer's transaction options.

    ``partitions`` fixes the number of files a batch adds.  With
    ``target_file_bytes`` (an output with a ``path``) it follows the feed: the
    batch's rows times the bytes a row took in the last batch, in files of about
    that size.
    """

    name: str
    rows: Callable[[DataFrame], DataFrame]
    path: str | None = None
    table: str | None = None
    fmt: str = "parquet"
    options: dict[str, str] = field(default_factory=dict)
    partitions: int | None = None
    target_file_bytes: int | None = None
    _last: dict[str, float] = field(default_factory=dict, compare=False)

    def __post_init__(self):
        if self.fmt != "kafka" and (self.path is None) == (self.table is None):
            raise ValueError(f"output {self.name}: give exactly one of path or table")
        if self.target_file_bytes is not None and (self.path is None or self.fmt == "delta"):
            raise ValueError(f"output {self.name}: file sizes need a path of plain files")

    def _sized(self, rows: DataFrame, n: int) -> DataFrame:
        """As many partitions as ``n`` rows fill files."""
        wanted = n * self._last.get("row_bytes", FIRST_ROW_BYTES) / self.target_file_bytes
        return rows.repartition(max(1, round(wanted)))

    def write(self, rows: DataFrame, query_id: str, batch_id: int, n: int | None = None) -> None:
        """``n``: number of rows, where file sizes are wanted."""
        if n is not None:
            rows = self._sized(rows, n)
        elif self.partitions:
            rows = rows.repartition(self.partitions)
        if self.fmt == "kafka":
            rows.write.format("kafka").options(**self.options).save()
        elif self.table is not None:
            _replace_partition(rows, self.table, self.fmt, self.options, query_id, batch_id)
        elif self.fmt == "delta":
            batch_writer(self.path, fmt="delta", options=self.options, app_id=query_id)(rows, batch_id)
        else:
            folder = f"{self.path}/{QUERY_COLUMN}={query_id}"
            batch_writer(folder, fmt=self.fmt, options=self.options)(rows, batch_id)
            if n:
                self._last["row_bytes"] = size(rows.sparkSession, f"{folder}/{BATCH_COLUMN}={batch_id}") / n


@dataclass(frozen=True)
class BatchReport:
    """A committed batch: rows written per output, and a sample of the first."""

    query_id: str
    batch_id: int
    counts: dict[str, int]
    sample: list[Row]


def _replace_partition(rows: DataFrame, table: str, fmt: str, options: dict[str, str],
                       query_id: str, batch_id: int) -> None:
    """Write a batch as its own partition of a catalog table; other partitions stay."""
    spark = rows.sparkSession
    if not spark.catalog.tableExists(table):
        ids = {QUERY_COLUMN: F.lit(query_id), BATCH_COLUMN: F.lit(batch_id).cast("long")}
        none = spark.createDataFrame([], rows.withColumns(ids).schema)
        none.write.format(fmt).options(**options).partitionBy(QUERY_COLUMN, BATCH_COLUMN).saveAsTable(table)
    view = f"batch_{uuid.uuid4().hex}"
    names = [c for c in spark.table(table).columns if c not in (QUERY_COLUMN, BATCH_COLUMN)]
    rows.select(*names).createTempView(view)
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {table} PARTITION ({QUERY_COLUMN} = '{query_id}', "
                  f"{BATCH_COLUMN} = {int(batch_id)}) SELECT * FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def query_id_of(spark: SparkSession, checkpoint: str) -> str:
    """The id a checkpoint gave its query when it was created."""
    return json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]


def _observed(rows: DataFrame, sample: int) -> tuple[DataFrame, Observation]:
    """``rows``, observed: their number, and ``sample`` of them, each task
    giving its first few."""
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("n")]
    if not sample:
        return rows.observe(seen, *metrics), seen
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    first = F.collect_list(F.when(F.col(_PLACE) < sample, F.struct(*rows.columns)))
    metrics.append(F.slice(first, 1, sample).alias("sample"))
    return rows.withColumn(_PLACE, place).observe(seen, *metrics).drop(_PLACE), seen


def append_outputs(df: DataFrame, checkpoint: str, outputs: Sequence[Output], *,
                   trigger: str | None = "60 seconds", metrics_path: str | None = None,
                   sample: int = 0, on_batch: Callable[[BatchReport], None] | None = None,
                   query_name: str | None = None) -> StreamingQuery:
    """Start one query that writes every batch of ``df`` to all ``outputs``.

    With several outputs, or file sizes wanted, the batch is kept (memory, then
    disk) while it is written, so that what ``df`` computes, the parse that splits it for
    instance, runs once.  ``metrics_path``: a row per batch and output (see
    :func:`read_metrics`), replaced when a batch is replayed.  ``sample``: so
    many rows of the first output in ``on_batch``'s report, gathered by the
    write itself; a task contributes at most that many.
    """
    names = [o.name for o in outputs]
    if not names or len(set(names)) != len(names):
        raise ValueError("outputs need names of their own")
    owner: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not owner:
            owner.append(query_id_of(spark, checkpoint))
        counts: dict[str, int] = {}
        shown: list[Row] = []
        kept = len(outputs) > 1 or any(o.target_file_bytes for o in outputs)
        if kept:
            batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for output in outputs:
                first = output is outputs[0]
                rows = output.rows(batch)
                n = rows.count() if output.target_file_bytes else None  # fills the kept batch, which the write reads
                rows, seen = _observed(rows, sample if first else 0)
                output.write(rows, owner[0], batch_id, n)
                counts[output.name] = int(seen.get["n"])
                if first and sample:
                    shown = list(seen.get["sample"])
        finally:
            if kept:
                batch.unpersist()
        if metrics_path is not None:
            made = [(owner[0], batch_id, name, n) for name, n in counts.items()]
            (spark.createDataFrame(made, METRICS_SCHEMA).coalesce(1).drop(QUERY_COLUMN, BATCH_COLUMN)
             .write.mode("overwrite").parquet(f"{metrics_path}/{QUERY_COLUMN}={owner[0]}/{BATCH_COLUMN}={batch_id}"))
        if on_batch is not None:
            on_batch(BatchReport(owner[0], batch_id, counts, shown))

    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return apply_trigger(writer, trigger).start()


def read_batches(spark: SparkSession, path: str, fmt: str = "parquet", keep_ids: bool = False) -> DataFrame:
    """The rows of an output's files, each batch once; ``keep_ids`` keeps the
    query and batch id columns."""
    rows = spark.read.format(fmt).load(path)
    return rows if keep_ids else rows.drop(QUERY_COLUMN, BATCH_COLUMN)


def read_metrics(spark: SparkSession, metrics_path: str) -> DataFrame:
    """Rows per query, batch and output, as recorded by all runs so far."""
    return spark.read.schema(METRICS_SCHEMA).parquet(metrics_path)

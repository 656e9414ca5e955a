"""Session construction and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every changefeed session carries.  The flat row renders event
# time as a string in the session zone; UTC keeps that string stable.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Python call-site capture for error messages; it doubles the driver
    # time spent building the long expression trees of the feed plans.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app_name: str = "changefeed",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the changefeed defaults.

    ``conf`` entries win over the defaults; on a cluster the master and the
    resources come from spark-submit, so ``master`` stays None there.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _checkpoint_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    # Unset: a folder of this machine serves only where everything runs on it.
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="changefeed-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def parallelism(spark: SparkSession) -> int:
    """Cores the cluster offers (``spark.default.parallelism`` when set)."""
    conf = spark.conf.get("spark.default.parallelism", None)
    if conf:
        return int(conf)
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # a remote (Connect) session has no SparkContext here
        return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    Streaming checkpoints, landed feed files and written tables go here, so
    every executor and a restarted driver see the same files.  The location
    comes from ``spark.checkpoint.dir``; only when the session has none is a
    private one created.
    """
    return f"{_checkpoint_root(spark)}/changefeed/{name}-{uuid.uuid4().hex[:12]}"

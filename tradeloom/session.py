"""Session defaults and the shared folder that jobs may write to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the models rely on; everything else is left to the cluster.
SESSION_DEFAULTS = {
    # Malformed text must fail a Silver model instead of turning into NULL.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Shuffle sizes, join strategy and skew are decided from runtime statistics.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot key even where the split costs one more exchange downstream.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_local_base: str | None = None


def build_session(app_name: str = "tradeloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SESSION_DEFAULTS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: the cluster's ``spark.checkpoint.dir``.

    A temporary folder stands in for it only in local mode, where driver and
    executors are one machine; on a cluster a missing setting is an error.
    """
    global _local_base
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="tradeloom-")
    return _local_base


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let ``DataFrame.checkpoint`` write to the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_folder(spark)}/checkpoints")

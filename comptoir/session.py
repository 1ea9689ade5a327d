"""Spark session defaults and the shared scratch location.

Everything that must survive an executor loss (materialized intermediates,
stream checkpoints) goes under ``spark.checkpoint.dir``: on a cluster that is
shared storage named by the cluster configuration. It is only *set* here when
the session has none, which happens in local runs and tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "comptoir", extra: dict | None = None) -> SparkSession:
    """Session with AQE, skew-join handling and the UI off.

    ``shuffle_partitions`` is the *initial* partition count; AQE coalesces
    small partitions and splits skewed ones at run time, so on a cluster it
    should be sized for the largest shuffle (roughly input bytes / 128 MB).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a hot join key even when that costs one more shuffle downstream (the partial
        # aggregate after the join then shrinks the hot key to one row per task).
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Remove checkpoint() files once nothing references them (a refresh runs indefinitely).
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        # Independent report jobs of a refresh cycle share the executors fairly.
        "spark.scheduler.mode": "FAIR",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, default: str | None = None) -> str:
    """Return the session's shared checkpoint folder, setting one only if unset.

    A cluster names it in ``spark.checkpoint.dir``. Without it, a local
    session (tests, bench) gets a fresh folder; a non-local session without
    it is a configuration error, since a machine-local folder would not
    survive the loss of that machine.
    """
    cur = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getCheckpointDir()
    if cur:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(cur)
        return cur
    master = spark.sparkContext.master or ""
    if default is None:
        if not master.startswith("local"):
            raise RuntimeError(f"{CHECKPOINT_CONF} is not set; a cluster must name a shared folder")
        default = tempfile.mkdtemp(prefix="comptoir-ckpt-")
    os.makedirs(default, exist_ok=True) if "://" not in default else None
    spark.conf.set(CHECKPOINT_CONF, default)
    spark.sparkContext.setCheckpointDir(default)
    return default


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path below the checkpoint folder for one materialized table."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, "comptoir", *parts, uuid.uuid4().hex])

"""Session defaults and the shared scratch location.

Scratch data (landing zones, stage tables, stream checkpoints) always goes
under the folder the cluster names in ``spark.checkpoint.dir``. Only when the
session has none (local runs, tests) is a fresh private folder created.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    # Parquet is compressed: scale file sizes before the broadcast size check,
    # so a table is only broadcast when its decompressed rows fit the threshold.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.ui.enabled": "false",
}


def get_session(master: str = "local[8]", shuffle_partitions: int = 8, **conf) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster pass the cluster master and a shuffle partition count sized
    so one partition is ~128-256 MB of shuffle data at the target scale.
    """
    b = SparkSession.builder.master(master).appName("contrail")
    for k, v in {**DEFAULT_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir, creating a private one only if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="run-", dir=os.environ.get("CONTRAIL_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared checkpoint dir (never reused)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/contrail/{name}-{uuid.uuid4().hex[:12]}"

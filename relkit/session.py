"""Session construction and the shared scratch location.

Library code never builds its own session; callers pass one in.  The helpers
here are for tests, the bench and the driver entry point, plus the one place
that decides where intermediate tables (snapshots, checkpoints, stream state)
are written: under ``spark.checkpoint.dir``, which on a cluster names a folder
every executor can reach.  Only when that setting is absent (local tests) do we
fall back to a fresh folder of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    # Adaptive execution: runtime coalescing, skew-join splitting and
    # broadcast conversion from real shuffle statistics.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Nothing in this library relies on a wall-clock ordering of files.
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "relkit", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session configured the way the library expects."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(_DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only where none is set."""
    global _FALLBACK_DIR
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not configured:
        # No shared folder was named: a private one serves a local master only.
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if _FALLBACK_DIR is None:
            _FALLBACK_DIR = tempfile.mkdtemp(prefix="relkit-ckpt-")
        configured = _FALLBACK_DIR
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(configured)
    return configured


_FALLBACK_DIR: str | None = None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint location.

    Every call returns a fresh path so reruns and retried jobs never read
    half-written output of an earlier attempt.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/relkit/{name}-{uuid.uuid4().hex[:12]}"


def default_parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def env_int(name: str, default: int) -> int:
    try:
        return int(os.environ.get(name, default))
    except ValueError:
        return default

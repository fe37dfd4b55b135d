"""Session construction and the shared scratch location.

Every plan in this package is a lazy DataFrame plan; the only session
settings it relies on are UTC, ANSI mode, AQE and dynamic partition
overwrite. Scratch output (sink round trips, stream checkpoints) always goes
under the cluster's ``spark.checkpoint.dir`` so that it lives on shared
storage; a private temp folder is only created when that setting is unset,
which is the case in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tessel", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a private one only if unset."""
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext (e.g. Spark Connect)
        sc = None
    root = sc.getCheckpointDir() if sc is not None else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if root and sc is not None:
            sc.setCheckpointDir(root)
    if not root:
        master = sc.master if sc is not None else ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        # Local runs and tests: one machine, so a private folder is shared.
        local = tempfile.mkdtemp(prefix="tessel-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(local)
            root = sc.getCheckpointDir()
        else:
            root = local
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/tessel/{name}-{uuid.uuid4().hex[:12]}"


def per_entity_partitions(spark: SparkSession) -> int:
    """Partition count for the per-entity stages.

    Everything after the per-supplier shuffle (nesting, JSON, alignment, a
    folder for each symbol) costs time per document while its shuffle data is
    small, so AQE's by-size coalescing would squeeze it into a few tasks. An
    explicit count is never coalesced: the session's shuffle width, and a task
    for each core at least.
    """
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))

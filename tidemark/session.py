"""Spark session defaults and the shared work folder.

Everything the engine persists (bronze files, watermarks, silver tables,
stream checkpoints, gold targets) lives under one root on shared storage.
On a cluster that root is the folder named by ``spark.checkpoint.dir``; we
only pick a local folder when the session leaves it unset (tests, laptops).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings the engine relies on. They are defaults: a cluster's own
# values win because ``builder.config`` is only applied to new sessions.
DEFAULT_CONF = {
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # joins and skewed REBALANCE partitions, switch to broadcast when a side
    # turns out small at runtime (a measured, not guessed, size).
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Zone-less source timestamps; keep rendering stable across hosts.
    "spark.sql.session.timeZone": "UTC",
    # Gold targets replace only the buckets a merge touched.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Keyed streaming state (silver dedup) grows with the key space:
    # RocksDB keeps it off-heap and checkpoints incrementally.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", app: str = "tidemark",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Session for tests and local runs; on a cluster use the cluster's session."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_engine_conf(spark: SparkSession) -> None:
    """Set the runtime-modifiable defaults on an existing session.

    Only SQL confs that are still at Spark's defaults are touched, so a
    cluster's explicit choices are kept.
    """
    for k, v in DEFAULT_CONF.items():
        if k.startswith("spark.ui"):
            continue
        try:
            if spark.conf.get(k, None) is None:
                spark.conf.set(k, v)
        except Exception:  # static conf on a running session
            pass


def work_root(spark: SparkSession) -> str:
    """Shared root for everything the engine writes.

    Reads ``spark.checkpoint.dir`` from the session. Only when it is unset
    (local tests) a fresh local folder is created and registered both as the
    conf and as the RDD checkpoint dir, so ``DataFrame.checkpoint()`` works.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd"))
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder under the work root (one per run)."""
    return f"{work_root(spark)}/tidemark/{name}/{uuid.uuid4().hex[:12]}"

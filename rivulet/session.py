"""Session and scratch-folder helpers.

Nothing here is needed to *use* the library (every function takes the
caller's DataFrames), but tests, the bench and the streaming helpers need
a session with sane settings and a shared folder for checkpoints.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; all of them are plain Spark options.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app: str = "rivulet", extra: dict | None = None) -> SparkSession:
    """A session with AQE, skew handling and UTC time; used by tests and bench."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set and point at shared storage: results that
    are read back lie below it. Only a local session (a test) may leave it
    unset; a private temporary folder is then made and registered, so later
    calls see the same value.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise ValueError(f"spark.checkpoint.dir must name a shared folder when the master is {master}")
    d = tempfile.mkdtemp(prefix="rivulet-ckpt-")
    spark.sparkContext.setCheckpointDir(d)
    return spark.sparkContext.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder below the checkpoint root (one per run)."""
    root = checkpoint_root(spark)
    return f"{root.rstrip('/')}/rivulet/{name}-{uuid.uuid4().hex[:12]}"


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def ensure_state_store(spark: SparkSession) -> None:
    """transformWithState needs the RocksDB provider; set it if the session has the default."""
    key = "spark.sql.streaming.stateStore.providerClass"
    cur = spark.conf.get(key, "")
    if "RocksDB" not in cur:
        spark.conf.set(key, SCALE_CONF[key])

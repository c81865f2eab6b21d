"""Session settings and the shared folder that jobs write intermediate tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_dir: str | None = None


def configure(spark: SparkSession) -> SparkSession:
    """Set the SQL options the library relies on; sizing (partitions, memory) stays with the cluster."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Split a hot join key even when the rows are shuffled once more afterwards.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # Merge a key's sessions inside each task before the shuffle, so a hot key sends few rows.
    spark.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    # Images and long texts reach Python in small batches, so a worker's memory stays small.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1024")
    # Window state lives on disk with incremental checkpoints instead of on the executor heap.
    spark.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``, or a temporary one in local mode."""
    global _local_dir
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="framekeel-")
    return _local_dir


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_dir(spark)}/framekeel/{name}-{uuid.uuid4().hex}"

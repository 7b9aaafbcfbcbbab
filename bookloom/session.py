"""Session settings the library relies on, and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that decide results or file layout; all of them can be changed on a running session.
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    # INT96 timestamps carry no Parquet statistics, so time filters could not skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Repeated keys in a webhook body: the last one wins instead of the body counting as broken.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Settings for speed only; a cluster's own values win over these.
SUGGESTED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Noting the Python line of every column expression takes longer than planning a wide projection.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

CHECKPOINT_DIR = "spark.checkpoint.dir"

SHUFFLE_BYTES = 256 * 1024 ** 2


def shuffle_partitions(shuffled_bytes: int, at_least: int = 200) -> int:
    """Reduce tasks for a shuffle of this size, about 256 MB each. Adaptive execution merges those that turn out
    small, but cannot split one of an aggregation that is too large, so rather too many than too few."""
    return max(at_least, -(-shuffled_bytes // SHUFFLE_BYTES))


def build_session(
    app: str = "bookloom", master: str | None = None, shuffled_bytes: int | None = None, **conf: str,
) -> SparkSession:
    """Start (or fetch) a session with the library's settings; `conf` overrides the suggested ones.

    `shuffled_bytes` is the largest expected shuffle: for a full build about the bytes of the id and channel columns.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffled_bytes is not None:
        conf = {"spark.sql.shuffle.partitions": str(shuffle_partitions(shuffled_bytes)), **conf}
    for key, value in {**SUGGESTED, **REQUIRED, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings that decide results to a session somebody else started."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for tables written along the way, visible to every executor.

    It lies under the folder the cluster names in `spark.checkpoint.dir`. Only a local session may fall back to
    the machine's temporary folder.
    """
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors can reach")
        base = tempfile.mkdtemp(prefix="bookloom-")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"

"""Session settings every entry point relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Window state lives off-heap and is checkpointed as a change log.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
# Settings for a new session: the time zone is required for right results, the rest is sizing.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    **STATE_CONF,
}


# Batch shuffles of a cluster session start from many partitions, which adaptive execution merges to
# the advisory size. Statistics of that many partitions are averages, unless skewed ones are recorded.
# Larger scan tasks keep the number of map outputs, and with it the blocks of a shuffle, in bounds.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "16384",
    "spark.shuffle.accurateBlockSkewedFactor": "5",
}


def with_settings(builder: SparkSession.Builder, parallelism: int | None = None) -> SparkSession.Builder:
    """Apply :data:`SESSION_CONF` to a session builder, with a fixed shuffle parallelism or the cluster's."""
    sizing = CLUSTER_CONF if parallelism is None else {"spark.sql.shuffle.partitions": str(parallelism)}
    for key, value in {**SESSION_CONF, **sizing}.items():
        builder = builder.config(key, value)
    return builder


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the duration of a block."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session time zone, which the hour columns and window bounds depend on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for intermediate tables and stream checkpoints.

    It lies under ``spark.checkpoint.dir``, which a cluster points at storage that every executor
    reaches. Only a local master may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), "tidemark-scratch")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"

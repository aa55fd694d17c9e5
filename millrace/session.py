"""Session settings the jobs are written for, and the shared folder they keep state in."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HEAP_PROVIDER = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"

SETTINGS = {
    # Plans are re-sized at run time: partitions are merged or split to the advisory size, and hot join keys
    # are split over several tasks.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # also where the split costs one more exchange, as between two joins on the same key
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    # Dictionaries and dimensions are broadcast only while their measured size stays under this limit;
    # above it Spark falls back to a shuffle join.
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    STATE_PROVIDER: ROCKSDB_PROVIDER,
}


SHUFFLE_PARTITION_BYTES = 128 * 1024**2

# 1 TB at the advisory size; adaptive execution merges what a smaller shuffle leaves empty.
INITIAL_PARTITIONS = 8192


def shuffle_partitions(data_bytes: int) -> int:
    """How many partitions a shuffle of that much data should start with; small ones are merged at run time."""
    return max(-(-data_bytes // SHUFFLE_PARTITION_BYTES), 8)


def build_session(
    app: str = "millrace", master: str | None = None, data_bytes: int | None = None, **overrides: str
) -> SparkSession:
    """A session with the settings above; ``overrides`` use ``__`` for the dots of a setting name.

    ``data_bytes``: how much data the largest shuffle of the job moves, if known. On a cluster a shuffle otherwise starts with
    ``INITIAL_PARTITIONS``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    if data_bytes is not None:
        builder = builder.config(initial, str(shuffle_partitions(data_bytes)))
    elif not (master or "").startswith("local"):
        builder = builder.config(initial, str(INITIAL_PARTITIONS))
    for key, value in overrides.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def several_states(spark: SparkSession) -> Iterator[None]:
    """Streams started in this block can hold several states per key, in sessions made elsewhere too: Spark's default store holds one only.

    A stream takes its settings when it is started, and one with a checkpoint those it began with. A store that was chosen for the session stays.
    """
    before = spark.conf.get(STATE_PROVIDER)
    if before != HEAP_PROVIDER:
        yield
        return
    spark.conf.set(STATE_PROVIDER, ROCKSDB_PROVIDER)
    try:
        yield
    finally:
        spark.conf.set(STATE_PROVIDER, before)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder for one run, under the checkpoint folder the cluster names (``spark.checkpoint.dir``).

    Executors of a cluster do not share the driver's disk, so a temporary folder is used on a local master only.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        base = tempfile.mkdtemp(prefix="millrace-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"

"""Session settings the jobs expect, and the shared folder for checkpoints."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Fixed value: the shop's clock. Text timestamps carry no zone and mean this one.
SHOP_ZONE = "Asia/Shanghai"

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# Runtime setting: a query's shuffle files go when it ends.
SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def settings(shuffle_partitions: int | None = None) -> dict[str, str]:
    """Spark settings used by every job.

    Adaptive execution sizes shuffle partitions at run time and splits skewed join partitions, so the
    joins in this package carry no broadcast hints: a side is broadcast only when Spark's own size
    check allows it, and otherwise the join is a sort-merge join whose hot keys adaptive execution splits.
    """
    conf = {
        "spark.sql.session.timeZone": SHOP_ZONE,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
        # State of the keyed jobs is checkpointed as deltas, not as whole snapshots.
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return conf


def build_session(
    app: str = "retailflow",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**settings(shuffle_partitions), **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for streaming checkpoints, as named by the cluster in ``spark.checkpoint.dir``."""
    root = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path for a landed intermediate under the shared folder; a temporary one only for a single local process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        root = checkpoint_root(spark, tempfile.mkdtemp(prefix="retailflow-") if master.startswith("local") else None)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Writes made inside drop their shuffle files as they end, not when the driver's memory is next swept."""
    before = spark.conf.get(SHUFFLES_END, None)
    spark.conf.set(SHUFFLES_END, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_END)
        else:
            spark.conf.set(SHUFFLES_END, before)

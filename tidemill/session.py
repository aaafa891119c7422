"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def session(app: str = "tidemill", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the operators were written for.

    Shuffle partitions are left to the cluster's own setting: AQE coalesces from there.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a session of one JVM (``local[n]``) without that setting gets a temporary folder; elsewhere a machine-local folder
    would be lost with its machine, so a missing setting is an error. Checkpoints are removed with the last reference.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="tidemill-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A new, not yet existing path below the shared folder."""
    return f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes in here drop the shuffle files they made when they end, not when the driver happens to collect its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, old)


def pinned(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, so that later steps see fixed partitions."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)

"""Session settings the library depends on, and the shared checkpoint folder."""

from __future__ import annotations

import os
import shutil
import tempfile

from pyspark.sql import SparkSession

_shipped: set[str] = set()

ROCKSDB_PROVIDER = (
    "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
)


def configure(spark: SparkSession) -> SparkSession:
    """Set the SQL options every job in this package expects.

    UTC keeps alert times comparable between engines; duplicate JSON keys must
    resolve to the last one instead of failing the document. A task takes a
    bounded share of a shuffle, whose rows are many times as large in memory.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16m")
    allow_duplicate_keys(spark)
    return spark


def allow_duplicate_keys(spark: SparkSession | None = None) -> None:
    spark = spark or SparkSession.getActiveSession()
    if spark is not None:
        spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB with changelog uploads.

    Deduplication here has no horizon, so its state outgrows the executor heap.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
    )


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder that cuts lineage: the cluster's own, or a fresh one in tests."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not context.master.startswith("local"):
            raise RuntimeError(
                "set spark.checkpoint.dir to a folder every executor can reach"
            )
        shared = tempfile.mkdtemp(prefix="tidewatch-checkpoint-")
    context.setCheckpointDir(shared)
    return context.getCheckpointDir()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Only what runs Python in tasks needs it, and only where the package is not
    installed on the cluster already.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    base = os.path.join(tempfile.mkdtemp(prefix="tidewatch-"), "tidewatch")
    archive = shutil.make_archive(
        base, "zip", root_dir=os.path.dirname(package), base_dir=os.path.basename(package)
    )
    context.addPyFile(archive)
    _shipped.add(context.applicationId)

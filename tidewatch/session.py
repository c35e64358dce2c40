"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A customer may hold a large share of all events: let AQE split such join
    # partitions even where that costs one more exchange further up.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Unlike INT96, it has statistics, so filters on time skip files.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Window state lives on disk, not on the executor heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app_name: str = "tidewatch", **settings: str) -> SparkSession:
    """A session with the engine's settings; keyword `a__b` sets option `a.b`."""
    builder = SparkSession.builder.appName(app_name)
    extra = {key.replace("__", "."): value for key, value in settings.items()}
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by `spark.checkpoint.dir`.

    A machine-local folder is used only when the whole session is one machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    # Iterative fits cut their lineage here.
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"

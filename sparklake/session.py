"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the transforms rely on. They are safe on any size of input:
# AQE picks the join strategy from measured sizes and splits skewed partitions.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even where that costs one more shuffle afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # the JVM never compiles a method above 8000 bytes; a wide cleaning projection in one
    # such method runs interpreted, several times slower than split into small ones
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # a job's shuffle files go when it ends, not when the driver happens to collect its garbage: a load of
    # several jobs needs the room of the largest one
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # the state of a stream grows with what its watermark allows: it lies on disk, not on the heap, and a
    # micro-batch saves what it changed. A checkpoint that was begun with another provider keeps that one
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def build_session(
    app: str = "sparklake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Build a session with the library's settings.

    ``shuffle_partitions`` is the *initial* number; AQE merges small ones. On a cluster
    take about (bytes shuffled / 128 MB); locally about the number of cores.
    """
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    # call sites of every column expression help while debugging and cost time in jobs
    builder = builder.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SQL_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the library's SQL settings to a session somebody else built."""
    for key, value in SQL_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for ``purpose`` that every executor can reach.

    It lies in the folder the cluster names in ``spark.checkpoint.dir``. A local
    session without that setting gets a temporary folder; a cluster session without it
    is refused, because a machine-local folder would lose data with its machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="sparklake-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"

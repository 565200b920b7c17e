"""Session settings for local tests and for a cluster."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# What the jobs rely on; everything else is left to the deployment.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split hot join keys even where that costs one more shuffle behind the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Size of a task's share of a shuffle, and so about that of a written file.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Do not record a Python stack for every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # Read parquet timestamps without zone the same way on every file.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def local_session(cores: str | int = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """One-process session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lapwright")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def configure(spark: SparkSession) -> SparkSession:
    """Apply what answers depend on to a session that was made elsewhere."""
    for key in ("spark.sql.session.timeZone", "spark.sql.adaptive.forceOptimizeSkewedJoin"):
        spark.conf.set(key, SETTINGS[key])
    return spark


@contextmanager
def without_broadcasts(spark: SparkSession) -> Iterator[None]:
    """What is planned inside shuffles both sides of a join, so that no table passes through the driver.

    Stored tables lie compressed and sorted: Spark takes their size from the files, less the columns that are not read, and would
    broadcast millions of rows as less than its threshold.
    """
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Shuffles of what runs inside are deleted when it ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``, or the context's checkpoint folder.

    Only where a session names none, as in local tests, is a new local folder
    made and remembered in the session.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        folder = spark.conf.get("lapwright.scratch", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = tempfile.mkdtemp(prefix="lapwright-")
        spark.conf.set("lapwright.scratch", folder)
    return folder.rstrip("/")

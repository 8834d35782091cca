"""Spark sessions for tests and the bench; a cluster brings its own session."""

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    # do not record a Python call site for every column expression
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # bars of one file per series may come with nanoseconds
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    # checkpoint files go with the table that they hold
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def local_session(cores="8", app="barworks"):
    """A local[cores] session with the settings the operators expect."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", os.environ.get("BARWORKS_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
    )
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _checkpoint_root(spark):
    """The shared checkpoint folder; only a session of one process may fall back to a folder of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="barworks-"))
    return context.getCheckpointDir()


@contextmanager
def shuffles_deleted(spark):
    """Shuffle files of queries that run in here go when their query ends, not when the driver next collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def settle(df):
    """Cut lineage through the shared checkpoint folder."""
    _checkpoint_root(df.sparkSession)
    with shuffles_deleted(df.sparkSession):
        return df.checkpoint()


def shared_folder(spark):
    """A new folder name under the shared checkpoint folder."""
    return f"{_checkpoint_root(spark)}/{uuid.uuid4().hex}"

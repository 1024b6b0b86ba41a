"""Where intermediate files go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only where it is unset, as in local tests, a temporary folder takes its place.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="scrubline-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def scratch_dir(spark: SparkSession) -> str:
    """This application's own folder below the shared one; its store deletes it when the driver ends."""
    path = f"{shared_dir(spark)}/scrubline-{spark.sparkContext.applicationId}"
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = there.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(there):
        store.mkdirs(there)
        store.deleteOnExit(there)
    return path


def new_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate files that nothing else has."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"

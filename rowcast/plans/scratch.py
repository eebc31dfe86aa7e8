"""Folders for tables written in passing, shared by all executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder.

    It is ``spark.checkpoint.dir`` of the session, or what ``setCheckpointDir``
    was given. Where neither is set, a local master gets a new folder of its
    own; on a cluster that is an error, as executors would not see the driver's disk.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", "") or context.getCheckpointDir() or ""
    if shared:
        return shared.rstrip("/")
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return "file:" + tempfile.mkdtemp(prefix="rowcast-")


def _files(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path that does not exist yet, in a folder removed when the application ends."""
    parent = f"{scratch_root(spark)}/rowcast/{uuid.uuid4().hex}"
    folder, files = _files(spark, parent)
    # Only an existing folder can be marked for removal.
    files.mkdirs(folder)
    files.deleteOnExit(folder)
    return f"{parent}/{name}"


def release(spark: SparkSession, path: str) -> bool:
    """Remove what was written at a path of ``scratch_path`` before the application ends."""
    parent = path.rpartition("/")[0]
    if "/rowcast/" not in parent:
        raise ValueError("not a scratch path")
    folder, files = _files(spark, parent)
    return files.delete(folder, True)


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder, in any file system Spark reads; an error if nothing is there."""
    folder, files = _files(spark, path)
    if not files.exists(folder):
        raise FileNotFoundError(path)
    return files.getFileStatus(folder).isDirectory()

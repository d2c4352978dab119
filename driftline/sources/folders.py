"""Folders for what a job writes on its way."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder's path, below ``spark.checkpoint.dir``, which the driver and all executors share.

    Only a session of one machine (master ``local``) may lack that; then it is a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        of = spark.sparkContext.applicationId
        root = _LOCAL[of] = _LOCAL.get(of) or tempfile.mkdtemp(prefix="spark-")
    return f"{root.rstrip('/')}/driftline/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}-{label}"


def written(rows: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder at once: what they come from runs this once."""
    path = shared_folder(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Move a file or folder within its file system; folders above the new place are made."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    at, goal = hadoop.Path(path), hadoop.Path(to)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(goal.getParent())
    if not system.rename(at, goal):
        raise OSError(f"{path} can't be moved to {to}")


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)

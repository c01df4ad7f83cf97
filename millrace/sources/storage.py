"""Folders on the file systems that Spark reaches, by Hadoop's own client.

Spark has no SQL for this, so these few calls go through the driver's JVM: they need a classic
session and do not work over Spark Connect.
"""

from __future__ import annotations

import time
from typing import Any

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str) -> tuple[Any, Any]:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), found


def path_exists(spark: SparkSession, path: str) -> bool:
    system, found = _open(spark, path)
    return system.exists(found)


def full_path(spark: SparkSession, path: str) -> str:
    """``path`` with its scheme and host, without doubled or closing slashes: one spelling per folder."""
    system, found = _open(spark, path)
    return system.makeQualified(found).toString()


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if it does not exist."""
    system, found = _open(spark, path)
    if not system.exists(found):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(found))


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds; nothing happens if it does not exist."""
    system, found = _open(spark, path)
    system.delete(found, True)


def renew_file(spark: SparkSession, path: str) -> None:
    """Give a file the present time of change."""
    system, found = _open(spark, path)
    system.setTimes(found, int(time.time() * 1000), -1)


def move_folder(spark: SparkSession, source: str, target: str) -> None:
    """Give a folder a new path, which must be free. HDFS and local disks do so at once."""
    system, found = _open(spark, target)
    if system.exists(found):
        raise FileExistsError(target)
    system.mkdirs(found.getParent())
    if not system.rename(spark._jvm.org.apache.hadoop.fs.Path(source), found):
        raise OSError(f"{source} could not be moved to {target}")

"""Folders on whatever file system the cluster uses."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import SparkSession

LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
MOST_LISTING_TASKS = 96
# The setting is the session's, which loads in several threads may share.
LISTING = Lock()


def join_path(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts])


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a folder through the Hadoop file system; False if there is none."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.delete(target, True)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder; none if there is no such folder."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(target):
        return []
    return [found.getPath().getName() for found in system.listStatus(target)]


@contextmanager
def listed_in_few_tasks(spark: SparkSession) -> Iterator[None]:
    """Tables read inside have their folders listed many to a task.

    Spark takes a task for each folder up to a setting, here lowered for that long: to
    start a task costs more than to list a folder.
    """
    with LISTING:
        before = spark.conf.get(LISTING_TASKS)
        spark.conf.set(LISTING_TASKS, str(min(int(before), MOST_LISTING_TASKS)))
        try:
            yield
        finally:
            spark.conf.set(LISTING_TASKS, before)

"""Intermediate tables that outlive a lost executor."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from granero.sources.folders import delete, join_path

CHECKPOINT_DIR = "spark.checkpoint.dir"
LOCAL_DIR = "granero.local.staging"
# The scope that staged tables belong to; loads in different threads have their own.
SCOPE: ContextVar[str] = ContextVar("staging_scope", default="kept")


def staging_dir(spark: SparkSession) -> str:
    """The shared folder the session names in ``spark.checkpoint.dir``.

    Only a local session may leave it unset; it then gets one temporary folder.
    """
    named = spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    local = spark.conf.get(LOCAL_DIR, None)
    if not local:
        local = tempfile.mkdtemp(prefix="granero-")
        spark.conf.set(LOCAL_DIR, local)
    return local


def staging_path(spark: SparkSession) -> str:
    """A fresh path in the staging folder."""
    return join_path(staging_dir(spark), "granero", SCOPE.get(), uuid.uuid4().hex)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted on leaving, so results must be written by then.

    Scopes may be nested, and threads of one session do not share them.
    """
    scope = uuid.uuid4().hex
    outer = SCOPE.set(scope)
    try:
        yield
    finally:
        SCOPE.reset(outer)
        delete(spark, join_path(staging_dir(spark), "granero", scope))


def stage(df: DataFrame) -> DataFrame:
    """Write the rows to the staging folder and read them back.

    Unlike a checkpoint this stays columnar, so later readers prune columns and
    the planner sees the true size.
    """
    path = staging_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

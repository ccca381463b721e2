"""The mart as Parquet tables."""

from __future__ import annotations

import uuid
from datetime import datetime
from math import ceil

from pyspark.sql import DataFrame, SparkSession

from granero.operators.numbering import surrogate_ids
from granero.operators.upsert import BUCKET, bucket_of, merge_buckets, one_per_key
from granero.sinks.parts import Part, PartLog, StaleTable, Version
from granero.sinks.targets import Target
from granero.sources.folders import join_path, listed_in_few_tasks
from granero.sources.staging import stage, staging_scope

__all__ = ["ParquetMart", "StaleTable"]

BATCH = "batch"
# A task writes several buckets where they are small and many, one after the other.
ROWS_PER_TASK = 1_000_000
LEAST_TASKS = 96


class ParquetMart:
    """Tables under one folder.

    A table without a key is a set of batches. Appending adds one, so loading twice
    stores rows twice unless the same ``batch_id`` is given, which replaces that batch.

    A table with a key lies in buckets by its key's hash. An upsert reads and writes
    only the buckets that its keys fall in; all others stay as they are. A table
    that outgrows ``rows_per_bucket`` is laid out once more, in at least twice as many
    buckets, so each row is rewritten for that a bounded number of times on average.

    Every write goes to new folders, and the table switches to them once they are
    complete: a failed write changes nothing, and readers of the old rows are not
    disturbed. A write fails if the table has changed since it began.
    """

    def __init__(
        self,
        spark: SparkSession,
        base: str,
        rows_per_bucket: int = 2_000_000,
        least_buckets: int = 16,
    ):
        self.spark = spark
        self.base = base
        self.rows_per_bucket = rows_per_bucket
        self.least_buckets = least_buckets
        self.log = PartLog(spark, base)

    def _write(self, target: Target, rows: DataFrame, name: str) -> str:
        folder = join_path(self.base, target.name, uuid.uuid4().hex, name)
        columns = target.schema.names
        if BUCKET in rows.columns:
            rows.select(*columns, BUCKET).write.partitionBy(BUCKET).parquet(folder)
        else:
            rows.select(*columns).write.parquet(folder)
        return folder

    def version(self, target: Target) -> Version:
        return self.log.current(target.name)

    def read(self, target: Target) -> DataFrame:
        return self._rows(target, list(self.version(target).parts.values()))

    def _rows(self, target: Target, parts: list[Part]) -> DataFrame:
        paths = [part.path for part in parts if part.path]
        if not paths:
            return self.spark.createDataFrame([], target.schema)
        with listed_in_few_tasks(self.spark):
            stored = self.spark.read.schema(target.schema).parquet(*paths)
        return stored.select(*target.schema.names)

    def has(self, target: Target, batch_id: str) -> bool:
        """Whether that batch was appended or upserted."""
        return (f"{BATCH}={batch_id}" if target.keys else batch_id) in self.version(target).parts

    def purge(self, target: Target, before: datetime) -> list[str]:
        """Delete the folders that newer ones had replaced by then; see ``PartLog.purge``."""
        return self.log.purge(target.name, before)

    # --- tables without a key -----------------------------------------------------

    def append(self, target: Target, rows: DataFrame, batch_id: str | None = None) -> None:
        """Add insert-ready rows; a generated id goes on after the largest stored.

        A batch that replaces one takes over its ids, beginning with the least.
        """
        if target.keys:
            raise ValueError(f"{target.name} has a key: upsert its rows")
        batch_id = batch_id or uuid.uuid4().hex
        version = self.version(target)
        first = None
        if target.generated:
            first = self._first_id(version, batch_id)
            rows = surrogate_ids(rows, target.order(), target.generated, start_at=first)
        path = self._write(target, rows, f"{BATCH}={batch_id}")
        part = Part(path, self._count(target, path), first)
        self._must_not_meet(target, version, batch_id, part)
        self.log.publish(version, {batch_id: part})

    def _count(self, target: Target, path: str) -> int:
        # Row counts come from the files' footers.
        return self.spark.read.schema(target.schema).parquet(path).count()

    def _first_id(self, version: Version, batch_id: str) -> int:
        replaced = version.parts.get(batch_id)
        if replaced and replaced.rows:
            return replaced.first_id
        used = [part.first_id + part.rows for name, part in version.parts.items() if name != batch_id]
        return max(used, default=1)

    def _must_not_meet(self, target: Target, version: Version, batch_id: str, part: Part) -> None:
        """A larger batch must not run into ids that later batches have."""
        if part.first_id is None:
            return
        others = (other for name, other in version.parts.items() if name != batch_id and other.rows)
        taken = min((other.first_id for other in others if other.first_id >= part.first_id), default=None)
        if taken is not None and part.first_id + part.rows > taken:
            raise ValueError(
                f"the batch has more rows than ids: {taken} belongs to a later batch of {target.name}"
            )

    def overwrite(self, target: Target, rows: DataFrame) -> None:
        """Replace the table; generated ids start at 1 again."""
        version = self.version(target)
        if target.keys:
            with staging_scope(self.spark):
                self._replace_buckets(target, Version(target.name, version.number), rows, version)
            return
        if target.generated:
            rows = surrogate_ids(rows, target.order(), target.generated)
        batch_id = uuid.uuid4().hex
        path = self._write(target, rows, f"{BATCH}={batch_id}")
        part = Part(path, self._count(target, path), 1 if target.generated else None)
        self.log.publish(version, {**dict.fromkeys(version.parts), batch_id: part})

    # --- tables with a key --------------------------------------------------------

    def upsert(self, target: Target, rows: DataFrame, batch_id: str | None = None) -> None:
        """Insert insert-ready rows or update those whose key is stored.

        The same rows again change nothing; a ``batch_id`` is only kept for ``has``.
        """
        version = self.version(target)
        marks = {f"{BATCH}={batch_id}": Part("", 0)} if batch_id else {}
        with staging_scope(self.spark):
            self._replace_buckets(target, version, rows, version, marks)

    def _buckets(self, version: Version, rows: int) -> int:
        """How many buckets a table of so many rows has; a power of two, never fewer than now."""
        buckets = version.buckets or self.least_buckets
        while rows > buckets * self.rows_per_bucket:
            buckets *= 2
        return buckets

    def _replace_buckets(
        self, target: Target, stored: Version, rows: DataFrame, read: Version, marks: dict[str, Part] = {}
    ) -> None:
        """Publish, after ``read``, the buckets of ``stored`` that the rows change, and ``marks``."""
        keys, updates = list(target.keys), list(target.updates)
        batch = stage(one_per_key(rows.select(*target.schema.names), keys, updates))
        most = stored.rows + batch.count()
        buckets = self._buckets(stored, most)
        # One row per bucket at most.
        met = {row[0] for row in batch.select(bucket_of(keys, buckets)).distinct().collect()}
        if buckets == stored.buckets:
            touched = [name for name in (self._name(buckets, bucket) for bucket in sorted(met)) if name in stored.parts]
        else:
            touched = [name for name, part in stored.parts.items() if part.path]
        dropped = [name for name in read.parts if name not in stored.parts or (name in touched and buckets != stored.buckets)]
        changes: dict[str, Part | None] = {**dict.fromkeys(dropped), **marks}
        if met or (touched and buckets != stored.buckets):
            written = len(met) if buckets == stored.buckets else buckets
            tasks = min(written, max(LEAST_TASKS, ceil(most / ROWS_PER_TASK)))
            merged = merge_buckets(
                self._rows(target, [stored.parts[name] for name in touched]), batch, keys, updates, buckets, tasks
            )
            changes.update(self._written(target, merged, buckets))
        if changes:
            self.log.publish(read, changes, buckets)

    @staticmethod
    def _name(buckets: int, bucket: int) -> str:
        return f"{bucket} of {buckets}"

    def _written(self, target: Target, merged: DataFrame, buckets: int) -> dict[str, Part]:
        folder = self._write(target, merged, "buckets")
        with listed_in_few_tasks(self.spark):
            stored = self.spark.read.schema(f"{BUCKET} int").parquet(folder)
        counted = stored.groupBy(BUCKET).count().collect()
        return {
            self._name(buckets, row[BUCKET]): Part(f"{folder}/{BUCKET}={row[BUCKET]}", row["count"])
            for row in counted
        }

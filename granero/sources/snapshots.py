"""Frozen copies of tables that expire."""

from __future__ import annotations

import hashlib
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granero.sources.folders import delete, join_path
from granero.sources.manifest import Entry, Manifest, utc_now

# Name suffix and lifetime of a snapshot.
SUFFIX = "_snapshot"
LIFETIME = timedelta(days=7)
# Name of manifest entries that say which folders a purge has deleted.
PURGED = "purged folders"
FILE = "_file"


def _copy_name(table: str) -> str:
    return table + SUFFIX


@dataclass(frozen=True)
class FileTable:
    """A table as files in a folder, which may come and go but are not changed in place."""

    path: str
    columns: tuple[str, ...] = ()
    format: str = "parquet"

    def read(self, spark: SparkSession, paths: list[str] | None = None) -> DataFrame:
        df = spark.read.format(self.format).load(paths or self.path)
        return df.select(*self.columns) if self.columns else df


Source = DataFrame | FileTable


def _identity(path: Column, length: Column, modified: Column) -> Column:
    """A name for a file as it is now; a file that is written again has another one."""
    return F.md5(F.concat_ws("|", path, length.cast("string"), F.unix_micros(modified).cast("string")))


class SnapshotStore:
    """Snapshots under one folder.

    ``if_exists`` says what happens while a table has an unexpired snapshot:
    ``"error"`` stops, ``"reuse"`` keeps reading the old copy, ``"new"`` takes a
    newer one, which later reads prefer. ``at_once`` tables are copied side by
    side, and none is visible before all are complete.

    Of a ``FileTable`` only files are copied that no unexpired snapshot of it has a copy
    of; a snapshot is the list of copies that belong to it, so an unchanged table is
    frozen again without writing a row.
    """

    def __init__(
        self,
        spark: SparkSession,
        base: str,
        lifetime: timedelta = LIFETIME,
        at_once: int = 4,
    ):
        self.spark = spark
        self.base = base
        self.lifetime = lifetime
        self.at_once = at_once
        self.manifest = Manifest(spark, base)

    def take(
        self,
        tables: dict[str, Source],
        if_exists: str = "error",
        now: datetime | None = None,
    ) -> dict[str, DataFrame]:
        """Freeze the tables and return the frozen copies."""
        if if_exists not in ("error", "reuse", "new"):
            raise ValueError(f"if_exists must be 'error', 'reuse' or 'new', not {if_exists!r}")
        now = now or utc_now()
        found = {} if if_exists == "new" else self.manifest.newest(map(_copy_name, tables), now)
        if found and if_exists == "error":
            raise FileExistsError(f"unexpired snapshots exist: {', '.join(sorted(found))}")
        missing = {name: table for name, table in tables.items() if _copy_name(name) not in found}
        with ThreadPoolExecutor(self.at_once) as pool:
            written = list(pool.map(lambda item: self._freeze(*item, now), missing.items()))
        if written:
            self.manifest.add(written)
        return self.read_all(list(tables), now)

    def _freeze(self, name: str, table: Source, now: datetime) -> Entry:
        if isinstance(table, FileTable):
            return self._freeze_files(name, table, now)
        path = join_path(self.base, _copy_name(name), now.strftime("%Y%m%dT%H%M%S%f"))
        table.write.parquet(path)
        rows = self.spark.read.schema(table.schema).parquet(path).count()
        return Entry(
            _copy_name(name), path, table.schema.json(), now, now + self.lifetime, rows
        )

    # --- tables of files ----------------------------------------------------------

    def _listed(self, table: FileTable) -> dict[str, str]:
        """The table's files now: identity and path. Their contents are not read."""
        try:
            files = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(table.path)
        except AnalysisException as error:
            raise FileNotFoundError(table.path) from error
        named = files.select("path", _identity(F.col("path"), F.col("length"), F.col("modificationTime")))
        return {identity: path for path, identity in named.collect()}

    def _copies(self, name: str, columns: str, now: datetime) -> dict[str, str]:
        """Copies of files that unexpired snapshots of these columns hold: identity and folder."""
        live = self.manifest.entries().where(
            (F.col("name") == _copy_name(name)) & (F.col("expires_at") > F.lit(now)) & (F.col("columns") == columns)
        )
        folders = live.select(F.explode(F.split("path", "\n")).alias("path")).distinct().collect()
        marked = [row["path"] for row in folders if f"/{FILE}=" in row["path"]]
        return {path.rpartition("=")[2]: path for path in marked}

    def _freeze_files(self, name: str, table: FileTable, now: datetime) -> Entry:
        schema = table.read(self.spark).schema
        files = self._listed(table)
        copies = self._copies(name, schema.json(), now)
        changed = {identity: path for identity, path in files.items() if identity not in copies}
        folder = join_path(self.base, _copy_name(name), uuid.uuid4().hex)
        if changed:
            rows = table.read(self.spark, list(changed.values()))
            source = F.col("_metadata")
            identity = _identity(
                source["file_path"], source["file_size"], source["file_modification_time"]
            )
            # Every task writes the rows of the files it reads; nothing is shuffled.
            rows.withColumn(FILE, identity).write.partitionBy(FILE).parquet(folder)
            copied = self._identities(folder)
            if unknown := copied - changed.keys():
                raise RuntimeError(f"{len(unknown)} files of {name} changed while they were copied")
            copies.update((identity, f"{folder}/{FILE}={identity}") for identity in copied)
        # Files without rows have no copy.
        kept = sorted(copies[identity] for identity in files if identity in copies)
        if not kept:
            empty = join_path(folder, "empty")
            self.spark.createDataFrame([], schema).write.parquet(empty)
            kept = [empty]
        count = self.spark.read.schema(schema).parquet(*kept).count()
        return Entry(
            _copy_name(name), "\n".join(kept), schema.json(), now, now + self.lifetime, count
        )

    def _identities(self, folder: str) -> set[str]:
        """The files that have rows in a folder of copies, by its subfolders."""
        schema = f"{FILE} string"
        try:
            rows = self.spark.read.schema(schema).parquet(folder)
        except AnalysisException:
            return set()
        return {row[0] for row in rows.select(FILE).distinct().collect()}

    # --- reading and cleaning -----------------------------------------------------

    def read_all(self, names: list[str], now: datetime | None = None) -> dict[str, DataFrame]:
        """The newest unexpired copy of each table."""
        found = self.manifest.newest(map(_copy_name, names), now)
        lacking = [name for name in names if _copy_name(name) not in found]
        if lacking:
            raise FileNotFoundError(
                f"no unexpired snapshot under {self.base} of: {', '.join(lacking)}"
            )
        return {name: found[_copy_name(name)].read(self.spark) for name in names}

    def identity(self, names: list[str], now: datetime | None = None) -> str:
        """A name for the newest unexpired copies of these tables together."""
        found = self.manifest.newest(map(_copy_name, names), now)
        paths = sorted(f"{name} {entry.created_at} {entry.path}" for name, entry in found.items())
        return hashlib.sha256("\n".join(paths).encode()).hexdigest()[:32]

    def read(self, name: str, now: datetime | None = None) -> DataFrame:
        return self.read_all([name], now)[name]

    def purge(self, now: datetime | None = None) -> list[str]:
        """Delete the folders that only expired snapshots have; returns those deleted.

        What was deleted is noted, so that no folder is tried again.
        """
        now = now or utc_now()
        entries = self.manifest.entries()
        folders = entries.select(
            F.explode(F.split("path", "\n")).alias("path"),
            ((F.col("name") == PURGED) | (F.col("expires_at") > F.lit(now))).alias("keeps"),
        )
        gone = folders.groupBy("path").agg(F.max("keeps").alias("keeps")).where(~F.col("keeps"))
        paths = [row.path for row in gone.select("path").toLocalIterator()]
        deleted = [path for path in paths if delete(self.spark, path)]
        if paths:
            self.manifest.add([Entry(PURGED, "\n".join(paths), "{}", now, None, len(paths))])
        return deleted

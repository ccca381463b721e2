"""The mart in a database, over JDBC, each load all or nothing.

Spark writes each partition in a transaction of its own, and a task that is run again
writes its rows again. So a load first stores its rows on shared storage, where every
row gets a number. They are copied from there to a staging table of that load alone.
One transaction in the database then moves every number once into the target and
notes the load in a ledger. A load that the ledger has changes nothing.

Statements are run by a ``Server``, which the caller makes from a connection.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from granero.operators.skew import POSITION, with_position
from granero.operators.upsert import one_per_key
from granero.sinks.targets import Target
from granero.sources.jdbc import balanced_scan, plain_scan
from granero.sources.staging import stage, staging_scope

Execute = Callable[[str], None]
LEDGER = "load_ledger"
ROW = "row_no"
LOAD_ID = re.compile(r"[A-Za-z0-9_.:-]{1,64}")


class Server(Protocol):
    """A connection to the database."""

    def query(self, statement: str) -> list[tuple]:
        """The rows of a statement that returns few."""

    def transact(self, statements: list[str]) -> None:
        """Run the statements in one transaction: all of them or, with an error, none."""


# --- statements -------------------------------------------------------------------


def insert_statement(target: Target, staging: str) -> str:
    columns = ", ".join(target.columns)
    return f"INSERT INTO {target.name} ({columns}) SELECT {columns} FROM {staging}"


def upsert_statement(target: Target, staging: str, dialect: str = "mysql") -> str:
    """One insert-or-update statement; ``dialect`` is ``"mysql"`` or ``"merge"``."""
    if dialect == "mysql":
        updates = ", ".join(f"{name} = VALUES({name})" for name in target.updates)
        return f"{insert_statement(target, staging)} ON DUPLICATE KEY UPDATE {updates}"
    if dialect == "merge":
        on = " AND ".join(f"t.{name} = s.{name}" for name in target.keys)
        updates = ", ".join(f"{name} = s.{name}" for name in target.updates)
        columns = ", ".join(target.columns)
        values = ", ".join(f"s.{name}" for name in target.columns)
        return (
            f"MERGE INTO {target.name} t USING {staging} s ON {on} "
            f"WHEN MATCHED THEN UPDATE SET {updates} "
            f"WHEN NOT MATCHED THEN INSERT ({columns}) VALUES ({values})"
        )
    raise ValueError(f"dialect must be 'mysql' or 'merge', not {dialect!r}")


def once_each(target: Target, staging: str) -> str:
    """The staged rows without those that a repeated task wrote again."""
    return f"(SELECT DISTINCT {ROW}, {', '.join(target.columns)} FROM {staging})"


def ledger_table() -> str:
    """The ledger's definition, to be run once; its key is what makes a load happen once."""
    return (
        f"CREATE TABLE {LEDGER} (load_id VARCHAR(64) NOT NULL, target VARCHAR(64) NOT NULL, "
        "row_count BIGINT NOT NULL, PRIMARY KEY (load_id, target))"
    )


def ledger_entry(load_id: str, target: Target, rows: int) -> str:
    return f"INSERT INTO {LEDGER} (load_id, target, row_count) VALUES ('{load_id}', '{target.name}', {rows})"


def staging_name(load_id: str, target: Target) -> str:
    """A table that no other load writes."""
    return f"{target.name}_{hashlib.sha256(load_id.encode()).hexdigest()[:16]}"


# --- the store --------------------------------------------------------------------


@dataclass
class DatabaseMart:
    """The target tables of a database; takes the place of a ``ParquetMart`` in a load.

    ``connections`` tasks write and read at once. The database assigns generated ids.
    """

    spark: SparkSession
    url: str
    server: Server
    dialect: str = "mysql"
    connections: int = 8
    batch_rows: int = 10_000
    properties: dict[str, str] = field(default_factory=dict)

    def has(self, target: Target, batch_id: str) -> bool:
        """Whether the ledger has that load of the target."""
        where = f"load_id = '{self._load_id(batch_id)}' AND target = '{target.name}'"
        return bool(self.server.query(f"SELECT row_count FROM {LEDGER} WHERE {where}"))

    def read(self, target: Target) -> DataFrame:
        """The stored rows; tables with a generated id are read in even shares of it."""
        if not target.generated:
            return plain_scan(self.spark, self.url, target.name, self.properties)
        return balanced_scan(
            self.spark, self.url, target.name, target.generated, self.connections, self.properties
        )

    def append(self, target: Target, rows: DataFrame, batch_id: str | None = None) -> None:
        """Add insert-ready rows, or nothing if the ledger has the ``batch_id``."""
        self._load(target, rows, batch_id, lambda staged: insert_statement(target, f"{staged} d"))

    def upsert(self, target: Target, rows: DataFrame, batch_id: str | None = None) -> None:
        """Insert or update insert-ready rows, reduced to one per key before they leave Spark."""
        batch = one_per_key(rows.select(*target.columns), list(target.keys), list(target.updates))
        alias = " d" if self.dialect == "mysql" else ""
        self._load(target, batch, batch_id, lambda staged: upsert_statement(target, staged + alias, self.dialect))

    @staticmethod
    def _load_id(batch_id: str) -> str:
        if not LOAD_ID.fullmatch(batch_id):
            raise ValueError(f"a load id has up to 64 letters, digits or signs _.:- and is not {batch_id!r}")
        return batch_id

    def _load(self, target: Target, rows: DataFrame, batch_id: str | None, move: Callable[[str], str]) -> None:
        load_id = self._load_id(batch_id or uuid.uuid4().hex)
        if self.has(target, load_id):
            return
        staging = staging_name(load_id, target)
        with staging_scope(self.spark):
            # Stored first: numbers are then the same however often a task runs, and
            # the few writing tasks have nothing else to do.
            numbered = with_position(stage(rows.select(*target.columns))).withColumnRenamed(POSITION, ROW)
            count = numbered.count()
            self._copy(numbered, staging)
        (copied,) = self.server.query(f"SELECT COUNT(DISTINCT {ROW}) FROM {staging}")
        if copied[0] != count:
            raise RuntimeError(f"{staging} has {copied[0]} of {count} rows")
        try:
            # The ledger's key stops a second load of this id before it moves a row.
            self.server.transact([ledger_entry(load_id, target, count), move(once_each(target, staging))])
        except Exception:
            if not self.has(target, load_id):
                raise
        self.server.transact([f"DROP TABLE {staging}"])

    def _copy(self, rows: DataFrame, staging: str) -> None:
        _stage(rows, self.url, staging, self.connections, self.batch_rows, self.properties)


# --- single writes ----------------------------------------------------------------


def _stage(
    rows: DataFrame,
    url: str,
    staging: str,
    connections: int,
    batch_rows: int,
    properties: dict[str, str],
) -> None:
    (
        rows.write.format("jdbc")
        .mode("overwrite")
        .options(url=url, dbtable=staging, **properties)
        .option("numPartitions", str(connections))
        .option("batchsize", str(batch_rows))
        .save()
    )


def append_jdbc(
    target: Target,
    rows: DataFrame,
    url: str,
    execute: Execute,
    staging: str | None = None,
    connections: int = 8,
    batch_rows: int = 10_000,
    properties: dict[str, str] | None = None,
) -> None:
    """Append insert-ready rows without a ledger; the database assigns generated ids."""
    staging = staging or f"{target.name}_staging"
    _stage(rows, url, staging, connections, batch_rows, properties or {})
    execute(insert_statement(target, staging))


def upsert_jdbc(
    target: Target,
    rows: DataFrame,
    url: str,
    execute: Execute,
    staging: str | None = None,
    dialect: str = "mysql",
    connections: int = 8,
    batch_rows: int = 10_000,
    properties: dict[str, str] | None = None,
) -> None:
    """Upsert insert-ready rows without a ledger, reduced to one per key before they leave Spark."""
    staging = staging or f"{target.name}_staging"
    batch = one_per_key(rows, list(target.keys), list(target.updates))
    _stage(batch, url, staging, connections, batch_rows, properties or {})
    execute(upsert_statement(target, staging, dialect))

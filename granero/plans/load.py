"""All flows in order."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from granero.operators import skew
from granero.plans import broker, coverage, product
from granero.sinks.targets import (
    COBERTURA,
    CORREDOR,
    PRODUCTO,
    PRODUCTO_COBERTURA,
    PRODUCTO_CORREDOR,
    Target,
)
from granero.sources.jdbc import read_back
from granero.sources.snapshots import SnapshotStore
from granero.sources.staging import stage, staging_scope

Tables = dict[str, DataFrame]


class Mart(Protocol):
    """Where the targets are stored: ``ParquetMart`` or ``DatabaseMart``."""

    spark: SparkSession

    def has(self, target: Target, batch_id: str) -> bool: ...

    def read(self, target: Target) -> DataFrame: ...

    def append(self, target: Target, rows: DataFrame, batch_id: str | None = None) -> None: ...

    def upsert(self, target: Target, rows: DataFrame, batch_id: str | None = None) -> None: ...


def load_mart(
    tables: Tables,
    mart: Mart,
    snapshots: SnapshotStore | None = None,
    if_exists: str = "error",
    batch_id: str | None = None,
    key_mode: str = "text",
    policy: skew.SkewPolicy | None = skew.SkewPolicy(),
    resume: bool = False,
) -> None:
    """Products first; then coverages and brokers with the stored products.

    Links are made for every stored product, those of earlier loads included,
    so loading twice without ``batch_id`` multiplies them. What is staged on the way
    is deleted at the end.

    With ``resume`` a load that failed goes on after its last complete step: unexpired
    snapshots are read again, and a target that has the batch is left as it is. The
    batch is then named after the snapshots, unless it has a ``batch_id``, so newer
    snapshots are a load of their own.
    """
    if resume and snapshots is None and batch_id is None:
        raise ValueError("a load can only be resumed by its batch_id or its snapshots")
    if snapshots:
        tables = snapshots.take(tables, "reuse" if resume else if_exists)
        if resume:
            batch_id = batch_id or snapshots.identity(list(tables))

    def step(write: Callable[..., None], target: Target, rows: Callable[[], DataFrame]) -> None:
        if not (resume and mart.has(target, batch_id)):
            write(target, rows(), batch_id)

    with staging_scope(mart.spark):
        step(mart.append, PRODUCTO, lambda: product.producto_load(tables, key_mode, policy))

        @cache
        def producto() -> DataFrame:
            return read_back(mart.read(PRODUCTO))

        @cache
        def covered() -> DataFrame:
            return stage(coverage.coverages(tables))

        step(mart.append, COBERTURA, lambda: coverage.cobertura_load(covered()))
        step(
            mart.append,
            PRODUCTO_COBERTURA,
            lambda: coverage.producto_cobertura_load(producto(), covered(), key_mode, policy),
        )
        step(mart.upsert, CORREDOR, lambda: broker.corredor_load(tables, key_mode, policy))
        step(
            mart.append,
            PRODUCTO_CORREDOR,
            lambda: broker.producto_corredor_load(tables, producto(), key_mode, policy),
        )

"""Projections that are more than a plain select."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename the named columns and keep all others."""
    return df.withColumnsRenamed(names)


def emit_rows(df: DataFrame, keep: list[str], values: Column, name: str) -> DataFrame:
    """One output row per element of the array ``values``; none for an empty one."""
    return df.select(*keep, F.explode(values).alias(name))

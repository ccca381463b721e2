"""Rows as lines of text, for reading by eye."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def text_dump(df: DataFrame, path: str, files: int | None = None) -> None:
    """Write one JSON object per row; ``files`` gathers them into that many files.

    Few files means few tasks, which suits small tables only.
    """
    lines = df.select(F.to_json(F.struct("*")).alias("value"))
    (lines.repartition(files) if files else lines).write.text(path)

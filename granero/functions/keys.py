"""Text join keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How key parts are joined, and the text of a missing part.
SEPARATOR = "-"
MISSING = "null"


def text_key(*parts: Column) -> Column:
    """Key text of one or more parts; never null, so no row is lost.

    A missing part reads ``null`` and therefore meets other missing parts (and
    the literal text ``null``). A separator inside a part is not escaped:
    (``a-b``, ``c``) and (``a``, ``b-c``) share one key.
    """
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(SEPARATOR))
        pieces.append(F.coalesce(part.cast("string"), F.lit(MISSING)))
    return pieces[0] if len(pieces) == 1 else F.concat(*pieces)


def with_single_key(df: DataFrame, column: str, name: str = "key") -> DataFrame:
    """Add the text key of one column and leave out rows that lack it."""
    return df.where(F.col(column).isNotNull()).withColumn(name, F.col(column).cast("string"))

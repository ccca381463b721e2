"""First row per distinct text inside a key group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_per_text(
    left: DataFrame,
    right: DataFrame,
    key: str,
    text: str,
    order: list[str],
    per: str = "group",
) -> DataFrame:
    """Distinct texts of ``right`` per key, each with a row of ``left``.

    Walking a group left row by left row and skipping texts already seen gives
    all of the group's texts to its first left row. So both sides are reduced on
    their own (first left row; distinct texts) and joined afterwards; the pairs
    of a group are never formed. ``order`` states which left row is first, the
    least one; it names all left columns but the key.

    ``per="row"`` keeps every distinct left row with every distinct text instead.
    """
    if per not in ("group", "row"):
        raise ValueError(f"per must be 'group' or 'row', not {per!r}")
    if sorted(order) != sorted(name for name in left.columns if name != key):
        raise ValueError(f"order must name the columns of {left.columns} but {key}, not {order}")
    texts = right.select(key, text).distinct()
    if per == "row":
        return left.distinct().join(texts, key)
    first = left.groupBy(key).agg(F.min(F.struct(*order)).alias("_first"))
    return first.select(key, "_first.*").join(texts, key)

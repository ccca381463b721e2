"""Gapless numbers over a stated order, without a one-task window.

The rows are written once in global order together with their partition and
their place in it. One count per partition then turns places into numbers. Both
steps write to the shared staging folder, so a lost executor cannot change a
number that was already given.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granero.operators.skew import POSITION, with_position
from granero.sources.staging import stage

# Fixed value: monotonically_increasing_id keeps the row place in the low 33 bits.
PLACE_BITS = 33
MOST = 2**31 - 1


def _must_fit(last: int, name: str) -> None:
    """Fail before anything is written; a cast would wrap where ANSI mode is off."""
    if last > MOST:
        raise OverflowError(f"{name} would reach {last}, above {MOST}")


def _ordered(df: DataFrame, order: list[Column]) -> DataFrame:
    # Staged first: the sort samples its input in a job of its own, and the
    # position, which lets equal rows spread over several partitions, must not
    # change when a task is run again.
    placed = with_position(stage(df))
    identity = F.col("_id")
    part = F.shiftright(identity, PLACE_BITS)
    return stage(
        placed.orderBy(*order, POSITION)
        .drop(POSITION)
        .withColumn("_id", F.monotonically_increasing_id())
        .withColumn("_part", part.cast("int"))
        .withColumn("_place", identity - F.shiftleft(part, PLACE_BITS))
        .drop("_id")
    )


def surrogate_ids(
    df: DataFrame, order: list[Column], name: str, start_at: int = 1
) -> DataFrame:
    """Number the rows start_at, start_at + 1, ... in the given order."""
    ordered = _ordered(df, order)
    counts = sorted(
        (row["_part"], row["count"]) for row in ordered.groupBy("_part").count().collect()
    )
    _must_fit(start_at + sum(count for _, count in counts) - 1, name)
    before = accumulate((count for _, count in counts), initial=start_at)
    offsets = F.broadcast(
        df.sparkSession.createDataFrame(
            [(part, offset) for (part, _), offset in zip(counts, before)],
            "_part int, _offset bigint",
        )
    )
    return (
        ordered.join(offsets, "_part")
        .withColumn(name, (F.col("_offset") + F.col("_place")).cast("int"))
        .drop("_part", "_place", "_offset")
    )


def group_counter(df: DataFrame, keys: list[str], order: list[Column], name: str) -> DataFrame:
    """Number the rows 1, 2, ... inside each key (null is a key), in the given order.

    A key may span partitions. Its rows are numbered per partition, then moved
    up by the rows it has in earlier partitions. Only the first key of a
    partition can continue from the one before, so that table has at most one
    row per partition and is broadcast.
    """
    ordered = _ordered(df, [F.col(key) for key in keys] + order)
    if ordered.count() > MOST:  # only then can one key have too many
        largest = ordered.groupBy(*keys).count().agg(F.max("count")).first()[0]
        _must_fit(largest, name)
    window = Window.partitionBy("_part", *keys).orderBy("_place")
    local = ordered.withColumn("_local", F.row_number().over(window))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    continued = (
        ordered.groupBy("_part", *keys)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.sum("_rows").over(earlier))
        .where(F.col("_before") > 0)
        .drop("_rows")
    )
    same = F.col("n._part") == F.col("c._part")
    for key in keys:
        same = same & F.col(f"n.{key}").eqNullSafe(F.col(f"c.{key}"))
    return (
        local.alias("n")
        .join(F.broadcast(continued).alias("c"), same, "left")
        .select(
            *(F.col(f"n.{column}") for column in df.columns),
            (F.col("n._local") + F.coalesce(F.col("c._before"), F.lit(0))).cast("int").alias(name),
        )
    )

"""Splitting of hot join keys.

A pair join writes rows(left) x rows(right) for every key, so a key that is
frequent on both sides makes one task produce the product. Adaptive execution
splits by input bytes and does not see that. Here the frequent keys are found
first, and their rows are dealt out over a grid of cells: a left row goes to one
grid line and meets every column, a right row the other way round. Every pair
meets in exactly one cell, so the result is unchanged.

The statistics come from a sample of the key columns; they steer the layout only
and never remove a row. Keys are ranked by the pairs they form, join by join, so a
key that is frequent on one side only takes no place from one that forms pairs.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from math import ceil, sqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granero.sources.staging import stage


class Cells(list):
    """Hot keys (key, parts of the left, parts of the right), those of the most pairs first.

    If there are more than a list should have, ``table`` has all of them, as ``_hot``,
    ``_left`` and ``_right``, and the list only the first.
    """

    table: DataFrame | None = None


# A table and, by (join, "left" or "right"), the key that the join has on it.
Keyed = tuple[DataFrame, dict[tuple[str, str], Column]]

POSITION = "_position"
# A row's cell, mixed with a hash of its key: for one key it is equal where row and
# column are. Joins sort by it first, as it tells most rows apart at once.
CELL = "_cell"


@dataclass(frozen=True)
class SkewPolicy:
    """When and how far a key is split.

    Every key that forms more than ``pairs_per_cell`` pairs is split into cells of about
    that many, however many such keys there are. At most ``top`` keys of each join reach
    the driver; if there are more, all of them stay in a stored table that is joined
    by key. Of a side that the sample misses up to 1/sample rows are assumed.
    """

    pairs_per_cell: int = 20_000_000
    sample: float = 0.01
    top: int = 1_000


def join_cells(tables: list[Keyed], policy: SkewPolicy) -> dict[str, Cells]:
    """Cells of each named join, in one job that reads every table once."""
    sampled = []
    for df, keys in tables:
        tagged = [
            F.struct(F.lit(join).alias("join"), F.lit(side).alias("side"), key.alias("key"))
            for (join, side), key in keys.items()
        ]
        # Sampled first, so keys are built for the sample only.
        part = df.sample(policy.sample, seed=7) if policy.sample < 1 else df
        sampled.append(part.select(F.explode(F.array(*tagged)).alias("at")).select("at.*"))

    def rows(side: str) -> Column:
        return F.count(F.when(F.col("side") == side, 1)).alias(side)

    counted = reduce(DataFrame.unionByName, sampled).groupBy("join", "key").agg(rows("left"), rows("right"))
    if policy.sample == 1:
        counted = counted.where((F.col("left") > 0) & (F.col("right") > 0))
    pairs = F.greatest("left", F.lit(1)).cast("double") * F.greatest("right", F.lit(1)) / policy.sample**2
    ranked = Window.partitionBy("join").orderBy(F.desc("pairs"), "key")
    hot = counted.withColumn("pairs", pairs).where(F.col("pairs") > policy.pairs_per_cell)
    if policy.sample == 1:
        # Whole tables are counted once; their hot keys are few beside them.
        hot = stage(hot)
    first = hot.withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= policy.top + 1)
    found: dict[str, Cells] = {join: Cells() for _, keys in tables for join, _ in keys}
    many = set()
    for row in first.orderBy("join", "place").collect():
        if row.place > policy.top:
            many.add(row.join)
            continue
        left, right = (max(1, side) / policy.sample for side in (row.left, row.right))
        found[row.join].append((row.key, *grid(left, right, policy)))
    if many:
        # Seldom needed, so the sample is only counted again then.
        stored = stage(hot.where(F.col("join").isin(list(many))).select("join", *_grid_columns(policy)))
        for join in many:
            found[join].table = stored.where(F.col("join") == join).drop("join")
    return found


def _grid_columns(policy: SkewPolicy) -> list[Column]:
    """``grid`` of counted keys, as columns."""
    left, right = (F.greatest(side, F.lit(1)).cast("double") / policy.sample for side in ("left", "right"))
    cells = F.ceil(left * right / policy.pairs_per_cell)
    lines = F.least(F.ceil(left), cells, F.greatest(F.lit(1), F.bround(F.sqrt(cells * left / right)).cast("bigint")))
    return [
        F.col("key").alias("_hot"),
        lines.cast("int").alias("_left"),
        F.least(F.ceil(right), F.ceil(cells / lines)).cast("int").alias("_right"),
    ]


def grid(left: float, right: float, policy: SkewPolicy) -> tuple[int, int]:
    """Parts of each side: about ``pairs_per_cell`` pairs a cell, with the fewest copies of rows."""
    cells = ceil(left * right / policy.pairs_per_cell)
    # Copies are left x (parts of the right) + right x (parts of the left).
    lines = min(ceil(left), cells, max(1, round(sqrt(cells * left / right))))
    return lines, min(ceil(right), ceil(cells / lines))


def with_position(df: DataFrame) -> DataFrame:
    """Number the rows of a stored table, to be carried to a later split.

    Stable under task retries only while the rows come straight from storage;
    number them before the first shuffle.
    """
    return df.withColumn(POSITION, F.monotonically_increasing_id())


def deal(df: DataFrame, key: str, cells: Cells, side: str) -> DataFrame:
    """Add ``_row`` and ``_column``, the grid cell(s) of each row, and ``CELL`` for both."""
    hot = getattr(cells, "table", None)
    if hot is None:
        hot = F.broadcast(df.sparkSession.createDataFrame(list(cells), "_hot string, _left int, _right int"))
    own, other = ("_left", "_right") if side == "left" else ("_right", "_left")
    own_cell, other_cell = ("_row", "_column") if side == "left" else ("_column", "_row")
    placed = df if POSITION in df.columns else with_position(df)
    placed = placed.join(hot, F.col(key) == F.col("_hot"), "left")
    return (
        placed.withColumn(
            own_cell,
            F.coalesce(F.pmod(F.xxhash64(POSITION), F.col(own)), F.lit(0)).cast("int"),
        )
        .withColumn(
            other_cell, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(other), F.lit(1)) - 1))
        )
        .withColumn(CELL, F.xxhash64(key).bitwiseXOR(F.shiftleft(F.col("_row").cast("bigint"), 32) + F.col("_column")))
        .drop("_hot", "_left", "_right")
    )

"""Joins of two tables on text keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granero.functions.keys import text_key
from granero.operators import skew

KEY = "_key"
VALUES_IN_LIST = 1_024


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _check_mode(key_mode: str) -> None:
    if key_mode not in ("text", "columns"):
        raise ValueError(f"key_mode must be 'text' or 'columns', not {key_mode!r}")


def carried(df: DataFrame, side: str) -> list[Column]:
    """Columns of a join side that travel along: those with a leading underscore."""
    return [F.col(f"{side}.{name}") for name in df.columns if name.startswith("_")]


def _same_part(left: DataFrame, right: DataFrame, a: str, b: str) -> Column:
    mine, other = F.col(f"l.{a}"), F.col(f"r.{b}")
    if left.schema[a].dataType == right.schema[b].dataType == T.IntegerType():
        return mine.eqNullSafe(other)
    return mine.cast("string").eqNullSafe(other.cast("string"))


def pair_join(
    left: DataFrame,
    right: DataFrame,
    on: list[tuple[str, str]],
    key_mode: str = "text",
    cells: skew.Cells | None = None,
) -> DataFrame:
    """Every left row with every right row of the same key (a bag).

    Columns of the result are reached as ``l.<name>`` and ``r.<name>``.

    ``key_mode="text"`` compares the key texts, where a missing part equals a
    missing part. ``"columns"`` compares part by part, null-safe: the same rows
    without the collisions of separators or of the text ``null``.

    ``cells`` splits hot keys (see ``skew``). A side that is to be split must
    come from storage or carry positions taken there.
    """
    _check_mode(key_mode)
    left = left.withColumn(KEY, text_key(*(F.col(name) for name, _ in on)))
    right = right.withColumn(KEY, text_key(*(F.col(name) for _, name in on)))
    if cells:
        left = skew.deal(left, KEY, cells, "left")
        right = skew.deal(right, KEY, cells, "right")
    if key_mode == "text":
        conditions = [F.col(f"l.{KEY}") == F.col(f"r.{KEY}")]
    else:
        conditions = [_same_part(left, right, a, b) for a, b in on]
        if not cells:
            # Equal parts have equal texts; a hash of them tells more apart than the first part.
            left, right = (side.withColumn(skew.CELL, F.xxhash64(KEY)) for side in (left, right))
    if cells or key_mode == "columns":
        # Compared first, so sorts seldom get to the conditions that follow.
        conditions = [F.col(f"l.{skew.CELL}") == F.col(f"r.{skew.CELL}"), *conditions]
    return left.alias("l").join(right.alias("r"), _all(conditions))


def pairs_with_values(
    left: DataFrame,
    right: DataFrame,
    on: list[tuple[str, str]],
    value: str,
    cells: skew.Cells | None = None,
    most: int = VALUES_IN_LIST,
) -> DataFrame:
    """Every left row with ``value`` of every right row of the same key text (a bag).

    The pairs of ``pair_join`` where they are far more than the rows: the values of a key
    meet its left rows in lists of at most ``most``, and pairs are made from them last. The
    left rows are dealt to all shuffle partitions, as their bytes do not tell what they
    will become. ``value`` is no column of the left and never null.
    """
    left = left.withColumn(KEY, text_key(*(F.col(name) for name, _ in on)))
    right = right.withColumn(KEY, text_key(*(F.col(name) for _, name in on)))
    keys = [KEY]
    if cells:
        left = skew.deal(left, KEY, cells, "left")
        right = skew.deal(right, KEY, cells, "right")
        keys = [skew.CELL, KEY]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(value)) - 1
    lists = (
        right.select(*keys, value, F.floor(place / most).alias("_list"))
        .groupBy(*keys, "_list")
        .agg(F.collect_list(value).alias("_values"))
    )
    tasks = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    same = _all([F.col(f"l.{key}") == F.col(f"r.{key}") for key in keys])
    joined = left.repartition(tasks, *keys).alias("l").join(lists.alias("r"), same)
    return joined.select("l.*", F.explode("r._values").alias(value)).drop(*keys)


def hot_cells(
    left: DataFrame,
    right: DataFrame,
    on: list[tuple[str, str]],
    policy: skew.SkewPolicy | None,
) -> skew.Cells:
    """Cells of a pair join of two stored tables; none without a policy."""
    if policy is None:
        return skew.Cells()
    tables: list[skew.Keyed] = [
        (left, {("pairs", "left"): text_key(*(F.col(name) for name, _ in on))}),
        (right, {("pairs", "right"): text_key(*(F.col(name) for _, name in on))}),
    ]
    return skew.join_cells(tables, policy)["pairs"]


def matched(
    left: DataFrame,
    right: DataFrame,
    on: list[tuple[str, str]],
    key_mode: str = "text",
    any_of: Column | None = None,
) -> DataFrame:
    """The left rows whose key some right row has, each once.

    The right side shrinks to its distinct keys before it is shuffled, so a key
    that very many right rows share costs one row per task. ``any_of`` is a condition
    on right rows; column ``_any`` says whether it holds for any of the key's.
    """
    _check_mode(key_mode)
    how = "left_semi" if any_of is None else "inner"
    flag = [] if any_of is None else [F.bool_or(any_of).alias("_any")]
    if key_mode == "text":
        keys = _distinct(right, [text_key(*(F.col(name) for _, name in on)).alias(KEY)], flag)
        keyed = left.withColumn(KEY, text_key(*(F.col(name) for name, _ in on)))
        return keyed.join(keys, KEY, how).drop(KEY)
    keys = _distinct(right, [F.col(name) for _, name in on], flag)
    conditions = [_same_part(left, keys, a, b) for a, b in on]
    joined = left.alias("l").join(keys.alias("r"), _all(conditions), how)
    return joined if any_of is None else joined.select("l.*", "r._any")


def _distinct(df: DataFrame, keys: list[Column], facts: list[Column]) -> DataFrame:
    return df.groupBy(*keys).agg(*facts) if facts else df.select(*keys).distinct()


def group_sizes(left: DataFrame, right: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """Per key text: rows on each side and the pairs they form.

    A key that only one side has forms no pair. Both sides are counted before
    they meet, so no group is ever gathered.
    """
    counted_left = (
        left.select(text_key(*(F.col(name) for name, _ in on)).alias("key"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("left_rows"))
    )
    counted_right = (
        right.select(text_key(*(F.col(name) for _, name in on)).alias("key"))
        .groupBy("key")
        .agg(F.count(F.lit(1)).alias("right_rows"))
    )
    rows = {name: F.coalesce(F.col(name), F.lit(0)) for name in ("left_rows", "right_rows")}
    return (
        counted_left.join(counted_right, "key", "full")
        .select("key", *(value.alias(name) for name, value in rows.items()))
        .withColumn("pairs", F.col("left_rows") * F.col("right_rows"))
    )

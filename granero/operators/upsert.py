"""Insert-or-update on a key, as DataFrame code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET = "_bucket"


def one_per_key(batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one that is last in ``order`` (descending pick).

    ``order`` must name every other column, so the pick is fully stated. The
    maximum of a struct is combined on the map side, so a key with very many
    rows does not travel.
    """
    others = [name for name in batch.columns if name not in keys]
    if set(order) != set(others):
        raise ValueError(f"order must name the columns {others}, not {order}")
    best = batch.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_best"))
    return best.select(
        *(F.col(name) if name in keys else F.col(f"_best.{name}") for name in batch.columns)
    )


def upsert(
    target: DataFrame, batch: DataFrame, keys: list[str], updates: list[str]
) -> DataFrame:
    """The target after the batch.

    Unknown keys are inserted. For known ones ``updates`` come from the batch
    and all other columns stay. ``batch`` holds one row per key (``one_per_key``).
    """
    on = None
    for key in keys:
        same = F.col(f"t.{key}").eqNullSafe(F.col(f"b.{key}"))
        on = same if on is None else on & same
    joined = (
        target.withColumn("_stored", F.lit(True))
        .alias("t")
        .join(batch.withColumn("_new", F.lit(True)).alias("b"), on, "full")
    )
    columns = []
    for name in target.columns:
        if name in updates:
            value = F.when(F.col("b._new"), F.col(f"b.{name}")).otherwise(F.col(f"t.{name}"))
        else:
            value = F.when(F.col("t._stored"), F.col(f"t.{name}")).otherwise(F.col(f"b.{name}"))
        columns.append(value.alias(name))
    return joined.select(*columns)


def bucket_of(keys: list[str], buckets: int) -> Column:
    """The bucket of a key among ``buckets``; twice as many split each in two."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def merge_buckets(
    stored: DataFrame, batch: DataFrame, keys: list[str], updates: list[str], buckets: int, tasks: int
) -> DataFrame:
    """``upsert`` of whole buckets, with their ``BUCKET``, in one shuffle by it.

    ``stored`` holds all rows of every bucket that ``batch`` meets. Both have one row
    per key. Rows leave in as many tasks as asked for, each bucket in one.
    """
    others = [name for name in stored.columns if name not in (*keys, *updates)]
    both = stored.withColumn("_new", F.lit(False)).unionByName(batch.withColumn("_new", F.lit(True)))
    placed = both.withColumn(BUCKET, bucket_of(keys, buckets)).repartition(tasks, BUCKET)
    # Grouping by bucket and key needs no further shuffle.
    merged = placed.groupBy(BUCKET, *keys).agg(
        F.max(F.struct("_new", *updates)).alias("_newest"),
        F.min(F.struct("_new", *others)).alias("_oldest"),
    )
    return merged.select(
        *(
            F.col(name) if name in keys else F.col(f"_newest.{name}" if name in updates else f"_oldest.{name}").alias(name)
            for name in stored.columns
        ),
        BUCKET,
    )

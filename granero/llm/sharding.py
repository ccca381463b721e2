"""Sharding by a consistent-hash ring with bounded loads.

Shards own many arcs of a ring (virtual nodes); a document's hash falls on one
arc. A shard takes no more than its share, and documents that find it full go on
clockwise to the next arc's shard. With shares that add up to all documents,
every shard ends exactly full.

Whether a document fits depends only on how many come before it, so the ring is
filled by counts per arc, of which there are shards x virtual nodes. A document
then finds its shard and its place there by its rank within its arc.
"""

from __future__ import annotations

import bisect
import hashlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from granero.sources.staging import stage

SHARDS = 24
VIRTUAL_NODES = 128
# The ring's positions are the upper 40 bits of a hash.
RING_BITS = 40
CELL_BITS = 12


def ring(shards: int, virtual_nodes: int) -> tuple[list[int], list[int]]:
    """End position and owner of every arc, clockwise."""
    arcs = sorted(
        (int(hashlib.md5(f"{shard}/{node}".encode()).hexdigest()[:10], 16), shard)
        for shard in range(shards)
        for node in range(virtual_nodes)
    )
    return [end for end, _ in arcs], [shard for _, shard in arcs]


def ring_cells(ends: list[int]) -> list[tuple[int, int, list[int]]]:
    """Equal cells of the ring: how many arcs end before each, and the ends inside."""
    width = 1 << (RING_BITS - CELL_BITS)
    starts = [bisect.bisect_left(ends, cell * width) for cell in range((1 << CELL_BITS) + 1)]
    return [(cell, at, ends[at:stop]) for cell, (at, stop) in enumerate(zip(starts, starts[1:]))]


def shares(total: int, shards: int, slack: float = 0.0) -> list[int]:
    """Most documents per shard: as equal as can be, or (1 + slack) times the mean."""
    if slack > 0:
        return [-(-int(total * (1 + slack)) // shards) + 1] * shards
    return [total // shards + (shard < total % shards) for shard in range(shards)]


def fill(counts: list[int], owners: list[int], most: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Runs (arc, first rank, end rank, shard, first slot) that place all documents.

    First every arc's documents go to its own shard, in arc order, as far as it has
    room; what is left moves one arc on at a time, all arcs in step.
    """
    room, taken = list(most), [0] * len(most)
    done = [0] * len(counts)
    runs = []
    waiting = [arc for arc, count in enumerate(counts) if count]
    for step in range(len(owners)):
        if not waiting:
            break
        for arc in waiting:
            shard = owners[(arc + step) % len(owners)]
            fits = min(room[shard], counts[arc] - done[arc])
            if fits:
                runs.append((arc, done[arc], done[arc] + fits, shard, taken[shard]))
                done[arc] += fits
                taken[shard] += fits
                room[shard] -= fits
        waiting = [arc for arc in waiting if done[arc] < counts[arc]]
    if waiting:
        raise ValueError("the shards' shares do not hold all documents")
    return runs


def shard(
    docs: DataFrame,
    shards: int = SHARDS,
    virtual_nodes: int = VIRTUAL_NODES,
    slack: float = 0.0,
) -> DataFrame:
    """Place of every document: doc_id, size, text_crc32, shard, slot.

    The size is the text's UTF-8 bytes plus 8, none for null. Slots are gapless from
    0 in a shard. With ``slack`` 0 the shards' counts differ by one at most; with
    more, fewer documents move when a shard is added and no shard has more than
    (1 + slack) times the mean. A document's hash is of its doc_id and its text's
    crc, so equal ids spread only if their texts differ; equal rows are told apart
    by their order in the stored table. A null id is hashed as such. An empty table
    gives an empty result. Columns other than doc_id and text are not read.
    """
    ends, owners = ring(shards, virtual_nodes)
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    position = F.shiftrightunsigned(F.xxhash64("doc_id", "text_crc32"), 64 - RING_BITS)
    cells = spark.createDataFrame(ring_cells(ends), "_cell int, _base int, _ends array<bigint>")
    placed = docs.select(
        "doc_id", (F.length(text) + 8).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32")
    ).withColumn("_position", position)
    passed = F.size(F.filter("_ends", lambda end: end < F.col("_position")))
    # The table has 2 ** CELL_BITS rows and as many ends as the ring.
    placed = stage(
        placed.join(
            F.broadcast(cells),
            F.shiftright("_position", RING_BITS - CELL_BITS).cast("int") == F.col("_cell"),
        )
        .withColumn("_arc", F.pmod(F.col("_base") + passed, F.lit(len(ends))).cast("int"))
        .drop("_cell", "_base", "_ends")
    )
    # One count per arc: shards x virtual nodes rows, however many documents there are.
    found = {row["_arc"]: row["count"] for row in placed.groupBy("_arc").count().collect()}
    counts = [found.get(arc, 0) for arc in range(len(ends))]
    runs = fill(counts, owners, shares(sum(counts), shards, slack))
    table = spark.createDataFrame(
        runs, "_run_arc int, _from bigint, _to bigint, shard int, _slot bigint"
    )
    order = Window.partitionBy("_arc").orderBy("_position", "doc_id", "text_crc32", "size")
    ranked = placed.withColumn("_rank", F.row_number().over(order) - 1)
    # At most one run per arc and one more for every shard that fills up, per step.
    return ranked.join(
        F.broadcast(table),
        (F.col("_arc") == F.col("_run_arc")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_to")),
    ).select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("_slot") + F.col("_rank") - F.col("_from")).cast("bigint").alias("slot"),
    )


def arc_of(position: int, ends: list[int]) -> int:
    """The arc a position falls on."""
    return bisect.bisect_left(ends, position) % len(ends)

"""Session settings for loads of a known size."""

from __future__ import annotations

# Bytes a shuffle partition should hold: a few times below a core's share of
# memory, so sorts and hash tables do not spill.
PARTITION_BYTES = 256 * 1024**2

# Above this many partitions the bookkeeping of a shuffle (map tasks times
# partitions) costs more than partitions that spill a little.
MOST_PARTITIONS = 50_000


def settings(
    shuffle_bytes: int, cores: int, partition_bytes: int = PARTITION_BYTES
) -> dict[str, str]:
    """Settings for a cluster with ``cores`` task slots.

    ``shuffle_bytes`` is the largest shuffle to expect: the used columns of the
    largest table, not all it stores. Adaptive execution merges partitions that
    turn out small and splits those of several times the target among tasks.
    """
    wanted = max(2 * cores, -(-shuffle_bytes // partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(min(wanted, MOST_PARTITIONS)),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.session.timeZone": "UTC",
    }

"""Small helpers that the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Blanks of the word rule [^\x20\x09-\x0D]+ and of line keys.
BLANKS = "\\x20\\x09-\\x0D"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@lru_cache(maxsize=1)
def _trim() -> Callable[[int], int]:
    """glibc's ``malloc_trim``; nothing where another library allocates."""
    return getattr(ctypes.CDLL(None), "malloc_trim", lambda _: 0)


def then_free(body: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``body`` for ``mapInArrow``; memory that Arrow and malloc keep in reserve is given back after it.

    Spark keeps the Python process of a task for later ones.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from body(batches)
        pa.default_memory_pool().release_unused()
        _trim()(0)

    return run


def let(value: Column, body) -> Column:
    """Compute ``value`` once per row and hand it to ``body`` as a variable.

    A column used inside a lambda would otherwise be computed anew for every element.
    """
    return F.transform(F.array(value), body)[0]


def blank_words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; none if it is null."""
    parts = F.split(F.coalesce(text, F.lit("")), f"[{BLANKS}]+")
    return F.filter(parts, lambda word: word != "")


# Places of a bitmap, 64 to a row: never more than 524,288 rows of 16 bytes.
PLACES = 1 << 25


def sifted(rows: DataFrame, own: Column, wanted: DataFrame, apart: bool = False) -> DataFrame:
    """The rows whose hash ``own`` is in ``wanted`` (one column of hashes), and some others.

    Spares an exact join that follows the shuffle of rows it would drop. The bitmap that
    is broadcast has a fixed size; far more hashes than places let more other rows pass.
    ``apart`` gives the rest: rows whose hash is surely not in ``wanted``.
    """
    place = F.pmod(F.col(wanted.columns[0]), F.lit(PLACES))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(place, F.lit(64)).cast("int"))
    bitmap = wanted.groupBy(F.floor(place / 64).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    mine = F.pmod(own, F.lit(PLACES))
    there = (F.floor(mine / 64) == F.col("_word")) & (F.getbit("_bits", F.pmod(mine, F.lit(64)).cast("int")) == 1)
    return rows.join(F.broadcast(bitmap), there, "left_anti" if apart else "left_semi")

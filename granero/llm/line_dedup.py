"""Line dedup with a sharded minimal perfect hash.

The distinct line hashes of the corpus are split into shards. For each shard a
minimal perfect hash gives every line a place of its own in compact arrays: a
fingerprint, a count in the smallest type that tells whether it suffices, and the
largest document id. Documents do
not join lines; they send the hashes of their lines to the shards and probe the
arrays. Texts stay where they are until the verdicts come back.

Lines in very many documents would make their shards' probes long. They are few
by their own definition, and documents probe them in a small table that every
task has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granero.sources.staging import stage

LEAST_CHARS = 20
LEAST_DOCS = 3
LINES_PER_SHARD = 8_192
# A line is hot above this share of all lines, and in any case in a million documents: at
# most 10,000 lines are, or one in a million of all (1 million of 10 ** 12, 24 MB).
HOT_SHARE = 1e-4
HOT_ROWS = 1_000
HOT_ALWAYS = 1_000_000
BLANKS = b" \t\n\x0b\x0c\r"

# The hash's levels: slots per key, odd multipliers, and how many before a list.
GAMMA = 2.0
LEVELS = 24
ODD = 0x9E3779B97F4A7C15
WORD = (1 << 64) - 1


def _key(line: bytes, least: int) -> bytes | None:
    """A line's key, or None if it has too few code points."""
    own = line.strip(BLANKS).lower()  # bytes.lower changes A-Z only
    if len(own) < least or (len(own) < 4 * least and len(own.decode()) < least):
        return None
    return own


def _hashes(key: bytes) -> tuple[int, int]:
    """64 bits that find a line and 32 more that confirm it."""
    digest = xxhash.xxh3_128_intdigest(key)
    low = digest & WORD
    return low - (1 << 64) if low >> 63 else low, (digest >> 64) & 0x7FFFFFFF


def _slots(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    mixed = keys.astype(np.uint64) * np.uint64((ODD * (2 * level + 3) & WORD) | 1)
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return ((mixed ^ (mixed >> np.uint64(32))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Places 0 to n - 1 for n distinct 64-bit keys.

    A key's slot in a level's bit array is its own if no other key of the level has
    it; the rest go to the next level. Its place is the number of set bits before.
    Keys left after the last level are kept in a sorted list.
    """

    def __init__(self, levels: list[np.ndarray], rest: np.ndarray):
        self.levels, self.rest = levels, rest
        self.ranks, before = [], 0
        for bits in levels:
            self.ranks.append(before + np.cumsum(bits, dtype=np.int64) - bits)
            before += int(bits.sum())
        self.before = before

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], keys
        for level in range(LEVELS):
            if not len(left):
                break
            size = max(8, int(GAMMA * len(left)))
            slots = _slots(left, level, size)
            alone = np.bincount(slots, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[slots]]
        return cls(levels, np.sort(left))

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; some place or -1 for a key that was not built in."""
        found = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            if not len(todo):
                return found
            slots = _slots(keys[todo], level, len(bits))
            hit = bits[slots]
            found[todo[hit]] = ranks[slots[hit]]
            todo = todo[~hit]
        if len(todo) and len(self.rest):
            at = np.minimum(np.searchsorted(self.rest, keys[todo]), len(self.rest) - 1)
            same = self.rest[at] == keys[todo]
            found[todo[same]] = self.before + at[same]
        return found

    def dump(self) -> tuple[list[int], bytes, bytes]:
        """Level sizes, their bits and the listed keys."""
        bits = b"".join(np.packbits(level).tobytes() for level in self.levels)
        return [len(level) for level in self.levels], bits, self.rest.astype("<i8").tobytes()

    @classmethod
    def load(cls, sizes: list[int], bits: bytes, rest: bytes) -> PerfectHash:
        levels, at = [], 0
        for size in sizes:
            stop = at + -(-size // 8)
            own = np.unpackbits(np.frombuffer(bits[at:stop], np.uint8), count=size)
            levels.append(own.astype(bool))
            at = stop
        return cls(levels, np.frombuffer(rest, "<i8"))


SHARD = (
    "shard bigint, sizes array<int>, bits binary, rest binary, "
    "fingerprints binary, counts binary, last binary"
)


def count_type(least_docs: int) -> np.dtype:
    """The smallest type of counts that reach ``least_docs`` before they stop."""
    return np.dtype(next(kind for kind in ("<u1", "<u2", "<u4", "<u8") if least_docs <= np.iinfo(kind).max))


def _build(least_docs: int):
    kind = count_type(least_docs)

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        keys = rows["key"].to_numpy(np.int64)
        hashed = PerfectHash.build(keys)
        at = hashed.places(keys)
        prints, counts = np.empty(len(keys), "<i4"), np.empty(len(keys), kind)
        last = np.empty(len(keys), "<i8")
        prints[at] = rows["print"].to_numpy()
        counts[at] = np.minimum(rows["n"].to_numpy().astype(np.uint64), np.uint64(np.iinfo(kind).max))
        last[at] = rows["last"].to_numpy(np.int64)
        sizes, bits, rest = hashed.dump()
        columns = [x.strip().split()[0] for x in SHARD.split(", ")]
        own = [int(rows["shard"].iloc[0]), sizes, bits, rest, prints.tobytes(), counts.tobytes(), last.tobytes()]
        return pd.DataFrame([own], columns=columns)

    return build


def _probe(least_docs: int):
    def probe(lines: pd.DataFrame, arrays: pd.DataFrame) -> pd.DataFrame:
        if lines.empty or arrays.empty:
            return pd.DataFrame({"doc": pd.Series(dtype="int64"), "key": pd.Series(dtype="int64")})
        own = arrays.iloc[0]
        hashed = PerfectHash.load(list(own["sizes"]), own["bits"], own["rest"])
        at = hashed.places(lines["key"].to_numpy(np.int64))
        same = (at >= 0) & (np.frombuffer(own["fingerprints"], "<i4")[at] == lines["print"].to_numpy())
        many = np.frombuffer(own["counts"], count_type(least_docs))[at] >= least_docs
        other = np.frombuffer(own["last"], "<i8")[at] != lines["doc"].to_numpy(np.int64)
        return lines.loc[same & many & other, ["doc", "key"]]

    return probe


def line_hashes(docs: DataFrame, least_chars: int = LEAST_CHARS) -> DataFrame:
    """One row per document and distinct key of enough code points: doc, key, print."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, prints = [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                lines = (text.as_py() or "").encode().split(b"\n")
                own = {_hashes(key) for key in {_key(line, least_chars) for line in lines} if key is not None}
                ids.extend([doc] * len(own))
                keys.extend(key for key, _ in own)
                prints.extend(mark for _, mark in own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(keys, pa.int64()), pa.array(prints, pa.int32())],
                ["doc", "key", "print"],
            )

    return docs.mapInArrow(hashed, "doc bigint, key bigint, print int")


def repeated_lines(
    lines: DataFrame, least_docs: int = LEAST_DOCS, lines_per_shard: int = LINES_PER_SHARD
) -> DataFrame:
    """What documents lose: rows (doc, key). ``lines`` must be a stored table."""
    rows = lines.count()
    shards = max(1, -(-rows // lines_per_shard))
    shard = F.pmod(F.col("key"), F.lit(shards))
    counted = stage(
        lines.groupBy("key").agg(
            F.count(F.lit(1)).alias("n"), F.max("doc").alias("last"), F.max("print").alias("print")
        )
    )
    limit = min(max(HOT_ROWS, int(rows * HOT_SHARE)), HOT_ALWAYS)
    hot = counted.where(F.col("n") > limit).select(
        F.col("key").alias("_hot"), F.col("last").alias("_last"), F.col("print").alias("_print"), F.col("n").alias("_n")
    )
    # Few enough for every task to have them.
    marked = lines.join(F.broadcast(hot), F.col("key") == F.col("_hot"), "left")
    by_table = marked.where(
        F.col("_hot").isNotNull()
        & (F.col("_n") >= least_docs)
        & (F.col("print") == F.col("_print"))
        & (F.col("doc") != F.col("_last"))
    ).select("doc", "key")
    arrays = (
        counted.withColumn("shard", shard).groupBy("shard").applyInPandas(_build(least_docs), SHARD)
    )
    probes = marked.where(F.col("_hot").isNull()).select("doc", "key", "print", shard.alias("shard"))
    by_arrays = (
        probes.groupBy("shard")
        .cogroup(arrays.groupBy("shard"))
        .applyInPandas(_probe(least_docs), "doc bigint, key bigint")
    )
    return by_arrays.unionByName(by_table)


NO_ID = -(1 << 63)


def dedup_lines(
    docs: DataFrame,
    least_chars: int = LEAST_CHARS,
    least_docs: int = LEAST_DOCS,
    lines_per_shard: int = LINES_PER_SHARD,
    carry: bool = False,
) -> DataFrame:
    """Texts without the lines that many documents share.

    A line's key is the line without blanks at its ends and with A-Z in lower case.
    Keys of at least ``least_chars`` code points in at least ``least_docs`` documents
    lose all their lines but those in the largest doc_id that holds them. Result:
    doc_id, n_lines, n_dropped, text; with ``carry`` also the other columns, as a
    struct ``rest``. A null or empty text is one empty line. Every row is a document;
    rows of one doc_id keep or lose a line together. A null doc_id counts as the
    smallest. Lines are told apart by 95 bits of a hash.
    """
    others = [name for name in docs.columns if name not in ("doc_id", "text")] if carry else []
    rest = [F.struct(*(F.col(f"`{name}`") for name in others)).alias("rest")] if others else []
    # Null ids become the smallest number, so that joins and maxima need no special case.
    doc = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc")
    own = docs.select(doc, F.col("text").cast("string").alias("text"), *rest)
    lines = stage(line_hashes(own.select("doc", "text"), least_chars))
    drops = (
        repeated_lines(lines, least_docs, lines_per_shard)
        .groupBy("doc")
        .agg(F.collect_set("key").alias("keys"))
        .withColumnRenamed("doc", "_doc")
    )
    kept_columns = ["rest"] if others else []
    joined = own.join(drops, F.col("doc") == F.col("_doc"), "left").select("doc", "text", "keys", *kept_columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, dropped, texts = [], [], []
            for text, keys in zip(batch.column(1), batch.column(2)):
                whole, gone = text.as_py() or "", keys.as_py()
                if not gone:
                    sizes.append(whole.count("\n") + 1)
                    dropped.append(0)
                    texts.append(whole)
                    continue
                gone, parts = set(gone), whole.encode().split(b"\n")
                named = ((_key(line, least_chars), line) for line in parts)
                kept = [line for key, line in named if key is None or _hashes(key)[0] not in gone]
                sizes.append(len(parts))
                dropped.append(len(parts) - len(kept))
                texts.append(b"\n".join(kept).decode())
            made = [pa.array(sizes, pa.int64()), pa.array(dropped, pa.int64()), pa.array(texts, pa.string())]
            carried = [batch.column(3)] if others else []
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *made, *carried], ["doc", "n_lines", "n_dropped", "text", *kept_columns]
            )

    schema = T.StructType(
        [
            T.StructField("doc", T.LongType()),
            T.StructField("n_lines", T.LongType()),
            T.StructField("n_dropped", T.LongType()),
            T.StructField("text", T.StringType()),
            *(field for field in joined.schema.fields if field.name in kept_columns),
        ]
    )
    return joined.mapInArrow(cut, schema).select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_lines", "n_dropped", "text", *kept_columns
    )


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents with their columns, texts cut by :func:`dedup_lines`."""
    cleaned = dedup_lines(docs, carry=True)
    sources = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    return cleaned.select(
        *(sources.get(name, F.col(f"rest.`{name}`")).alias(name) for name in docs.columns)
    )

"""Best-fit packing by sums of squares.

Documents become token pieces, and pieces become sequences of bounded length. A
piece goes to the open sequence where the sum over all residual gaps of the
squared number of open sequences with that gap becomes smallest, so that no gap
piles up. Pieces are placed from long to short, and a sequence is opened only
when none fits.

Pieces are dealt at random to shards of bounded size, and every shard is packed
on its own. Only lengths and identities travel there, never texts or ids.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granero.llm.tables import then_free
from granero.sources.staging import stage

CAPACITY = 2048
END_ID = 0
PIECES_PER_SHARD = 16_384
# Of each up to twice as many and those of one slice are kept, by every Python process.
CACHED_WORDS = 100_000
CACHED_CORES = 200_000
# Signs that often end a word; they are a run of their own.
TAIL = ".,;:!?*#$%&|<>"
# Letters that are lower-cased one by one and have no other normal form.
PLAIN = re.compile("[\\x00-\\x1b\\x20-\\x7eÀ-ÖØ-öø-įı-ſА-яЁё\\u2010-\\u2027\\u2030-\\u205e]*")
# ASCII signs that are blanks to some and not to the tokenizer.
ODD = re.compile("[\x1c-\x1f]")

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"
PACKED = PIECES + ", sequence_id bigint, offset bigint"


class Generations(dict):
    """A bounded memory: what the last ``most`` to twice ``most`` entries used stays."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.old = most, {}

    def lacking(self, keys: set) -> list:
        """The keys that are not known; the others are at hand afterwards."""
        if len(self) > self.most:
            self.old = dict(self)
            self.clear()
        new = keys - self.keys()
        kept = new & self.old.keys()
        self.update({key: self.old[key] for key in kept})
        return list(new - kept)


class TextIds:
    """Token ids of texts as little-endian 32-bit numbers.

    The tokenizer lower-cases, drops white space and encodes runs of letters, digits
    and signs apart, so the ids of a text are those of its words. The words of a
    batch are looked up once each in a bounded memory, and new ones are encoded in
    bulk. A text with letters other than Latin or Cyrillic ones, or with odd blanks,
    goes through the tokenizer as a whole.
    """

    def __init__(self, path: str | None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path or public_tokenizers.path("word_bpe_49k.json"))
        self.encoder.encode_special_tokens = True
        self.words, self.cores = Generations(CACHED_WORDS), Generations(CACHED_CORES)
        vocabulary = self.encoder.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for found in self.encoder.encode_batch_fast(texts, add_special_tokens=False):
            yield np.array(found.ids, "<u4").tobytes()

    def _letters(self, cores: list[str], size: int = 256) -> Iterator[tuple[str, bytes]]:
        """Runs of letters are encoded many at a time; each ends with its one end token."""
        parts = [cores[at : at + size] for at in range(0, len(cores), size)]
        for part, data in zip(parts, self.encode([" ".join(part) for part in parts])):
            stops = ((np.flatnonzero(self.ends[np.frombuffer(data, "<u4")]) + 1) * 4).tolist()
            if len(stops) != len(part):
                yield from zip(part, self.encode(part))
                continue
            start = 0
            for core, stop in zip(part, stops):
                yield core, data[start:stop]
                start = stop

    def _learn(self, words: list[str]) -> None:
        bare = [word.rstrip(TAIL) for word in words]
        letters = self.cores.lacking({core for core in bare if core.isalpha()})
        self.cores.update(self._letters(letters))
        cores, tails, other = self.cores, {"": b""}, []
        for word, core in zip(words, bare):
            if core in cores:
                tail = word[len(core) :]
                if tail not in tails:
                    tails[tail] = next(self.encode([tail]))
                self.words[word] = cores[core] + tails[tail]
            else:
                other.append(word)
        self.words.update(zip(other, self.encode(other)))

    def batch(self, texts: list[str]) -> Iterator[np.ndarray]:
        """The ids of each text."""
        plain = [
            not ODD.search(text) if text.isascii() else PLAIN.fullmatch(text) is not None
            for text in texts
        ]
        lowered = pa.array([text.lower() for text, own in zip(texts, plain) if own], pa.large_string())
        words = pc.utf8_split_whitespace(lowered)
        coded = words.flatten().dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        new = self.words.lacking(set(distinct))
        if new:
            self._learn(new)
        found = list(map(self.words.__getitem__, distinct))
        data = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int32, len(found)) // 4
        starts = np.cumsum(sizes, dtype=np.int32) - sizes
        at = coded.indices.to_numpy()
        bounds = words.offsets.to_numpy().tolist()
        spans = zip(bounds, bounds[1:])
        for text, own in zip(texts, plain):
            if own:
                own_words = at[slice(*next(spans))]
                count = sizes[own_words]
                stops = np.cumsum(count, dtype=np.int32)
                first = np.repeat(starts[own_words] - stops + count, count)
                yield data[first + np.arange(len(first), dtype=np.int32)]
            else:
                yield np.frombuffer(next(self.encode([text])), "<u4")


@lru_cache(maxsize=1)
def _text_ids(path: str | None) -> TextIds:
    return TextIds(path)


def batches_by_size(batch: pa.RecordBatch, text: int, most_bytes: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``most_bytes`` in column ``text``, or of one row."""
    ends = np.cumsum(pc.binary_length(batch.column(text)).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start, before = 0, 0
    while start < len(ends):
        stop = max(start + 1, int(np.searchsorted(ends, before + most_bytes, "right")))
        yield batch.slice(start, stop - start)
        start, before = stop, int(ends[stop - 1])


def token_pieces(
    docs: DataFrame,
    capacity: int = CAPACITY,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    keep_ids: bool = False,
) -> DataFrame:
    """Token pieces of all documents, each of at most ``capacity`` ids.

    A document is its text's ids and then ``end_id``; a null or empty text is
    ``end_id`` alone. Only longer documents are cut. Repeated rows give repeated
    pieces. ``keep_ids`` adds the ids themselves as ``ids array<int>``. Columns
    other than doc_id and text are not read.
    """
    schema = PIECES + (", ids array<int>" if keep_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _text_ids(tokenizer)
        end = np.array([end_id], "<u4")
        for batch in batches:
            for part in batches_by_size(batch, 1):
                rows: list[tuple] = []
                texts = [text or "" for text in part.column(1).to_pylist()]
                for doc, found in zip(part.column(0).to_pylist(), encoder.batch(texts)):
                    found = np.append(found, end)
                    for piece, at in enumerate(range(0, len(found), capacity)):
                        own = found[at : at + capacity]
                        row = (doc, piece, at, len(own), zlib.crc32(own.tobytes()))
                        rows.append((*row, own.view("<i4")) if keep_ids else row)
                columns = list(zip(*rows))
                arrays = [
                    pa.array(columns[0], pa.int64()),
                    pa.array(columns[1], pa.int32()),
                    *(pa.array(column, pa.int64()) for column in columns[2:5]),
                ]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    arrays.append(pa.array(columns[5], pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    own = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return own.mapInArrow(then_free(cut), schema)


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of every length, placed in the given order.

    With n(g) open bins of gap g, moving a bin from gap g to g - s changes the sum
    of squares by 1 - 2 n(g) + 1 + 2 n(g - s); a bin that becomes full leaves the
    sum. Ties go to the smallest gap.
    """
    leave = np.full(capacity + 1, np.inf)  # of a gap that no open bin has
    enter = np.ones(capacity + 1)
    enter[0] = 0.0
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made = 0
    for at, length in enumerate(lengths.tolist()):
        change = leave[length:] + enter[: capacity + 1 - length]
        best = int(change.argmin())
        if change[best] < np.inf:
            gap = length + best
            own = open_bins[gap].pop()
            left = len(open_bins[gap])
            leave[gap] = 1 - 2 * left if left else np.inf
            enter[gap] -= 2
        else:
            gap, own = capacity, made
            made += 1
        bins[at], offsets[at] = own, capacity - gap
        rest = gap - length
        if rest:
            open_bins[rest].append(own)
            leave[rest] = 1 - 2 * len(open_bins[rest])
            enter[rest] += 2
    return bins, offsets


def pack(
    pieces: DataFrame, capacity: int = CAPACITY, pieces_per_shard: int = PIECES_PER_SHARD
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of at most ``capacity``.

    Offsets are gapless from 0 in every sequence. Sequence ids are unique numbers
    without other meaning; a piece that fills a sequence has a negative one. The
    pieces must come from a stored table, as they are read twice. No pieces give
    no sequences; a missing length is an error. Which of several equal rows goes
    where is not defined.
    """
    short = pieces.where(F.col("length") < capacity)
    shards = max(1, -(-short.count() // pieces_per_shard))
    schema = PACKED

    def fill(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(
            ["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True]
        )
        bins, offsets = sum_of_squares(rows["length"].to_numpy(np.int64), capacity)
        shard = int(rows["_shard"].iloc[0])
        return rows.assign(sequence_id=(shard << 32) + bins, offset=offsets)[
            ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        ]

    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    # A random deal spreads a hot document's pieces and repeated rows alike.
    deal = F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id())
    dealt = short.select(*columns, F.pmod(deal, F.lit(shards)).alias("_shard"))
    packed = dealt.groupBy("_shard").applyInPandas(fill, schema)
    full = pieces.where(F.col("length") == capacity).select(
        *columns,
        (F.lit(-1) - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    return packed.unionByName(full)


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, **tokens) -> DataFrame:
    """One row per piece with its place; see :func:`token_pieces` and :func:`pack`."""
    return pack(stage(token_pieces(docs, capacity, **tokens)), capacity)


def sequences(packed: DataFrame, pieces_with_ids: DataFrame) -> DataFrame:
    """The packed sequences' ids: ``sequence_id``, ``ids array<int>``.

    ``pieces_with_ids`` are the same pieces with their ids; (doc_id, piece) must
    name a piece.
    """
    placed = packed.join(pieces_with_ids.select("doc_id", "piece", "ids"), ["doc_id", "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return placed.groupBy("sequence_id").agg(F.flatten(parts["ids"]).alias("ids"))

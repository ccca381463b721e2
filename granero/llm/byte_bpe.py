"""Byte-level BPE, encoded and decoded with a sentencepiece model made from the vocabulary.

A rank file lists byte strings and their ranks. It is written out as a sentencepiece
BPE model: every byte string becomes a piece of one letter per byte, scored by its
negative rank, and normalisation is the identity. That model merges the best scored
neighbours first, leftmost among equals, as a rank file asks. Texts are split by the
vocabulary's pattern, and every match is encoded by itself. Decoding looks up the
bytes of each id's piece and turns letters back into bytes.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granero.llm.fill_middle import slices
from granero.llm.packing import Generations

# Matches whose ids a task remembers, and text bytes it splits at a time.
CACHED_PIECES = 200_000
MOST_BYTES = 2_000_000
# Longer matches are rare, so they are encoded without being remembered.
CACHED_CHARS = 64
VOCABULARY = "byte_bpe_50k.tiktoken"

TOKENS = "doc_id bigint, n_tokens bigint, ids binary"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY)


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> list[bytes]:
    """The byte strings of a rank file in the order of their ranks, which run from 0 without a gap."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    ranked = sorted((int(rank), base64.b64decode(token)) for token, rank in pairs)
    if [rank for rank, _ in ranked] != list(range(len(ranked))):
        raise ValueError(f"ranks in {path} have gaps or repeats")
    return [token for _, token in ranked]


# --- bytes as letters -------------------------------------------------------------


def to_letters(data: bytes) -> bytes:
    """Byte b as the letter U+0100 + b, in UTF-8: two bytes for each."""
    own = np.frombuffer(data, np.uint8)
    out = np.empty(2 * len(own), np.uint8)
    out[0::2] = 0xC4 + (own >> 6)
    out[1::2] = 0x80 | (own & 0x3F)
    return out.tobytes()


def letters_of_each(parts: list[bytes]) -> Iterator[bytes]:
    """:func:`to_letters` of every part, in one go."""
    letters, at = to_letters(b"".join(parts)), 0
    for part in parts:
        yield letters[at : at + 2 * len(part)]
        at += 2 * len(part)


def from_letters(data: bytes) -> bytes:
    """The inverse of :func:`to_letters`."""
    own = np.frombuffer(data, np.uint8)
    return (((own[0::2] - 0xC4) << 6) | (own[1::2] & 0x3F)).astype(np.uint8).tobytes()


# --- the model file ---------------------------------------------------------------

# Wire types, field numbers and enum values of sentencepiece's model format.
VARINT, BYTES, FLOAT = 0, 2, 5
MODEL_PIECES, MODEL_TRAINER, MODEL_NORMALIZER = 1, 2, 3
PIECE_TEXT, PIECE_SCORE, PIECE_TYPE = 1, 2, 3
NORMAL, UNKNOWN = 1, 2
TRAINER_TYPE, TRAINER_SIZE, TRAINER_UNK = 3, 4, 40
BPE = 2
NORMALIZER_NAME, NORMALIZER_PREFIX, NORMALIZER_BLANKS, NORMALIZER_ESCAPE = 1, 3, 4, 5


def _varint(number: int) -> bytes:
    out = bytearray()
    while number > 0x7F:
        out.append(number & 0x7F | 0x80)
        number >>= 7
    out.append(number)
    return bytes(out)


def _field(number: int, value: int | float | bytes) -> bytes:
    if isinstance(value, bytes):
        return _varint(number << 3 | BYTES) + _varint(len(value)) + value
    if isinstance(value, float):
        return _varint(number << 3 | FLOAT) + struct.pack("<f", value)
    return _varint(number << 3 | VARINT) + _varint(value)


def model_file(tokens: list[bytes]) -> bytes:
    """A sentencepiece BPE model whose ids are the ranks of ``tokens``.

    Scores are single precision, which tells ranks apart up to 2 ** 24. The model must
    have an unknown piece; it gets the first free id and no text can reach it, as long
    as all 256 bytes are tokens.
    """
    if len(tokens) > 1 << 24:
        raise ValueError("too many tokens for exact scores")
    if missing := 256 - len({token for token in tokens if len(token) == 1}):
        raise ValueError(f"{missing} of 256 bytes are not in the vocabulary")
    pieces = [
        _field(PIECE_TEXT, letters) + _field(PIECE_SCORE, float(-rank)) + _field(PIECE_TYPE, NORMAL)
        for rank, letters in enumerate(letters_of_each(tokens))
    ]
    pieces.append(_field(PIECE_TEXT, b"<unk>") + _field(PIECE_SCORE, 0.0) + _field(PIECE_TYPE, UNKNOWN))
    trainer = _field(TRAINER_TYPE, BPE) + _field(TRAINER_SIZE, len(pieces)) + _field(TRAINER_UNK, len(tokens))
    normalizer = (
        _field(NORMALIZER_NAME, b"identity")
        + _field(NORMALIZER_PREFIX, 0)
        + _field(NORMALIZER_BLANKS, 0)
        + _field(NORMALIZER_ESCAPE, 0)
    )
    return (
        b"".join(_field(MODEL_PIECES, piece) for piece in pieces)
        + _field(MODEL_TRAINER, trainer)
        + _field(MODEL_NORMALIZER, normalizer)
    )


# --- encoding and decoding --------------------------------------------------------


class Encoder:
    """Ids of texts as little-endian 32-bit numbers."""

    def __init__(self, path: str, pattern: str):
        tokens = read_ranks(path)
        self.matches = regex.compile(pattern).findall
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model_file(tokens))
        # A match that is a token is that token, whatever merges would make of it.
        self.whole = {token: struct.pack("<I", rank) for rank, token in enumerate(tokens)}
        self.known = Generations(CACHED_PIECES)

    def _encoded(self, matches: list[str]) -> list[bytes]:
        out, rest, places = [], [], []
        for place, match in enumerate(matches):
            own = match.encode()
            out.append(self.whole.get(own, b""))
            if not out[-1]:
                rest.append(own)
                places.append(place)
        if rest:
            letters = list(letters_of_each(rest))
            for place, ids in zip(places, self.model.encode(letters, out_type=int, num_threads=1)):
                out[place] = struct.pack(f"<{len(ids)}I", *ids)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of every text."""
        found = [self.matches(text) for text in texts]
        distinct = set().union(*found)
        long = [match for match in distinct if len(match) > CACHED_CHARS]
        own = dict(zip(long, self._encoded(long)))
        new = self.known.lacking(distinct.difference(long))
        self.known.update(zip(new, self._encoded(new)))
        if own:
            own.update((match, self.known[match]) for match in distinct.difference(long))
        ids = (own or self.known).__getitem__
        return [b"".join(map(ids, matches)) for matches in found]


class Decoder:
    """The bytes of ids: all pieces' letters, turned back into bytes, in one run."""

    def __init__(self, path: str):
        tokens = read_ranks(path)
        self.data = np.frombuffer(from_letters(b"".join(letters_of_each(tokens))), np.uint8)
        self.sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def decode(self, data: bytes) -> bytes:
        """The bytes of little-endian ids."""
        ids = np.frombuffer(data, "<u4").astype(np.int64)
        if not len(ids):
            return b""
        sizes = self.sizes[ids]
        stops = np.cumsum(sizes)
        first = np.repeat(self.starts[ids] - stops + sizes, sizes)
        return self.data[first + np.arange(stops[-1])].tobytes()


@lru_cache(maxsize=1)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


@lru_cache(maxsize=1)
def _decoder(path: str) -> Decoder:
    return Decoder(path)


def encode(docs: DataFrame, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """Ids of every text: doc_id, n_tokens, ids (binary, little-endian unsigned 32-bit numbers).

    ``vocabulary`` is a rank file that every executor finds at this path; without it the
    installed one is taken. A null or empty text has no ids; whole texts are encoded,
    however long. One row for every row of ``docs``, repeats and null ids included; an
    empty table gives an empty result. Columns other than doc_id and text are not read,
    so their names do not matter.
    """

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary or default_vocabulary(), pattern or default_pattern())
        for batch in rows:
            for start, stop in slices(batch.column(1), MOST_BYTES):
                part = batch.slice(start, stop - start)
                ids = encoder.encode(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(own) // 4 for own in ids], pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    ["doc_id", "n_tokens", "ids"],
                )

    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text")).mapInArrow(batches, TOKENS)


def decode(tokens: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """The rows of ``tokens`` with ``decoded``, the bytes of their ``ids``.

    Null or no ids give no bytes. Ids that the vocabulary lacks are an error. All
    other columns of ``tokens`` stay; a column named decoded is replaced.
    """
    tokens = tokens.drop("decoded")
    place = tokens.columns.index("ids")
    schema = T.StructType([*tokens.schema, T.StructField("decoded", T.BinaryType())])

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(vocabulary or default_vocabulary())
        for batch in rows:
            decoded = [decoder.decode(ids.as_buffer() if ids.is_valid else b"") for ids in batch.column(place)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(decoded, pa.binary())], [*batch.schema.names, "decoded"]
            )

    return tokens.mapInArrow(batches, schema)

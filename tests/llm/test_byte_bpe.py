import base64
import hashlib
import struct

import numpy as np
import pytest
import regex
import tiktoken
from helpers_llm import LONG, ROWS, awkward, empty, save

from granero.llm import byte_bpe
from granero.llm.queries import QUERIES


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Encoder(byte_bpe.default_vocabulary(), byte_bpe.default_pattern())


@pytest.fixture(scope="module")
def tokens():
    return byte_bpe.read_ranks(byte_bpe.default_vocabulary())


@pytest.fixture(scope="module")
def library(tokens):
    ranks = {token: rank for rank, token in enumerate(tokens)}
    return tiktoken.Encoding("own", pat_str=byte_bpe.default_pattern(), mergeable_ranks=ranks, special_tokens={})


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def brute_force(match, ranks):
    """Merge the neighbours of least rank, leftmost first, until none is a token."""
    parts = [bytes([byte]) for byte in match]
    while len(parts) > 1:
        known = [(ranks[a + b], at) for at, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not known:
            break
        _, at = min(known)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return [ranks[part] for part in parts]


AWKWARD = [
    "", " ", "  \n\t x", "don't 'tis we'LL 12345 6½ ²", "<|endoftext|> <unk> <s>", "\x00\x1c\x85 　a",
    "日本語のテキスト", "👩‍👩‍👧‍👦 🇨🇱", "é ﬁ ΣΑΣ Ж", "a" * 5_000, " " * 3_000 + "x", "�﻿▁ Ġ", LONG,
]


def test_letters_and_back():
    every = bytes(range(256))
    assert byte_bpe.to_letters(every).decode() == "".join(chr(0x100 + byte) for byte in every)
    assert byte_bpe.from_letters(byte_bpe.to_letters(every)) == every


def test_every_token_is_reached_by_merges(codec, tokens):
    letters = list(byte_bpe.letters_of_each(tokens))
    assert codec.model.encode(letters, out_type=int) == [[rank] for rank in range(len(tokens))]


def test_ids_equal_the_library(codec, library, spark, sf_dir):
    texts = [row.text or "" for row in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    texts += AWKWARD + [row[1] or "" for row in ROWS]
    rng = np.random.default_rng(4)
    texts += ["".join(map(chr, rng.choice([9, 10, 32, 39, 48, 65, 97, 115, 0xE9, 0x3A9, 0x4E00, 0x1F600, 0x301, 0xA0], 60))) for _ in range(500)]
    found = codec.encode(texts)
    assert found == [packed(library.encode_ordinary(text)) for text in texts]
    decoder = byte_bpe.Decoder(byte_bpe.default_vocabulary())
    assert [decoder.decode(ids) for ids in found] == [text.encode() for text in texts]


def test_classes_of_letters_equal_the_library(codec, library):
    for block in range(0, 0x30000, 64):
        text = "".join(f"a{chr(c)}1{chr(c)}! {chr(c)}  {chr(c)}" for c in range(block, block + 64) if not 0xD800 <= c < 0xE000)
        assert codec.encode([text]) == [packed(library.encode_ordinary(text))]


def test_model_equals_brute_force_on_another_vocabulary(tmp_path):
    tokens = [bytes([byte]) for byte in range(256)] + [b"ab", b"bc", b"abc", b"aa", b"aaa", b"bcab", b"\xc3\xa9", b"c\xc3"]
    path = tmp_path / "own.ranks"
    path.write_bytes(b"".join(base64.b64encode(token) + b" %d\n" % rank for rank, token in enumerate(tokens)))
    own = byte_bpe.Encoder(str(path), r"\S+|\s+")
    ranks = {token: rank for rank, token in enumerate(tokens)}
    rng = np.random.default_rng(9)
    for _ in range(300):
        text = "".join(rng.choice(list("aabbccé "), rng.integers(0, 25)))
        want = []
        for match in regex.findall(r"\S+|\s+", text):
            data = match.encode()
            want += [ranks[data]] if data in ranks else brute_force(data, ranks)
        assert own.encode([text]) == [packed(want)]


def test_bad_vocabularies_are_refused(tmp_path):
    path = tmp_path / "gap"
    path.write_bytes(base64.b64encode(b"a") + b" 1\n")
    with pytest.raises(ValueError, match="gaps"):
        byte_bpe.read_ranks(str(path))
    with pytest.raises(ValueError, match="255 of 256"):
        byte_bpe.model_file([b"a"])


def test_little_memory_gives_the_same(codec, library, monkeypatch):
    own = byte_bpe.Encoder(byte_bpe.default_vocabulary(), byte_bpe.default_pattern())
    own.known = byte_bpe.Generations(3)
    for text in AWKWARD[:9] * 2:
        assert own.encode([text]) == [packed(library.encode_ordinary(text))]


def test_query_on_awkward_rows(spark, tmp_path, library):
    folder = save(spark, awkward(spark), tmp_path)
    want = []
    for row in ROWS:
        ids = library.encode_ordinary(row[1] or "")
        text = (row[1] or "").encode()
        want.append((row[0], len(ids), hashlib.sha256(packed(ids)).hexdigest(), hashlib.sha256(text).hexdigest()))
    found = [tuple(row) for row in QUERIES["op13_byte_bpe"](spark, folder).collect()]
    assert sorted(found, key=str) == sorted(want, key=str)


def test_empty_table_and_kept_columns(spark):
    assert byte_bpe.decode(byte_bpe.encode(empty(spark))).collect() == []
    rows = [(1, packed([0, 1]), "x"), (2, None, "y"), (3, b"", "z")]
    given = spark.createDataFrame([(i, ids and bytearray(ids), other) for i, ids, other in rows], "id int, ids binary, decoded string")
    assert [bytes(row.decoded) for row in byte_bpe.decode(given).orderBy("id").collect()] == [b'!"', b"", b""]
    assert struct.unpack("<I", packed([50_255])) == (50_255,)

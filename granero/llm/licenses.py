"""License scans by an exact set-similarity join with templates.

A block of text matches a template when it holds at least a given share of the
template's distinct words. Words are ordered by their frequency in the whole
corpus, rare first. A block can only match if it holds one of the first words of
a template (prefix filter), has enough words of the templates (length filter)
and enough of them after the word they met at (positional filter). What passes
is counted exactly, so no match is lost and none is added.

:func:`scan` takes lines as blocks, as its SQL does. :func:`notices` takes windows of
the whole text, across line ends, about as long as the template, and asks for the
words that tell a license from its relatives.

Templates are a parameter of bounded size and travel with the tasks. The corpus
never moves; only the counts of the templates' words are shuffled.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The phrases of the contract and their labels.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

# Notices of common licenses.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, "
    "are permitted provided that the following conditions are met",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "mit": "Released under the MIT License",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of "
    "this software and associated documentation files",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}

# Words without which a notice is not of that license, though it may hold most others.
TELLING = {
    "apache-2.0": "apache 2",
    "cc-by-nc": "cc by nc",
    "gpl-3.0": "gnu general public 3",
    "mit": "mit",
    "mpl-2.0": "mozilla public 2",
}

THRESHOLD = 0.8
MOST_TEMPLATE_WORDS = 100_000

MATCHES = (
    "doc_id bigint, n_words bigint, places array<struct<word:bigint,label:string>>, "
    "matches array<struct<block:bigint,template:string,containment:double>>"
)


def _table(newline: bytes) -> bytes:
    """Bytes of words in lower case; all others as blanks, but for the newline."""
    table = bytearray(b" " * 256)
    for byte in range(256):
        sign = bytes([byte])
        if byte >= 0x80 or sign.isalnum():
            table[byte] = sign.lower()[0]
    table[ord("\n")] = newline[0]
    return bytes(table)


# All bytes of a character beyond ASCII are at least 0x80 in UTF-8.
LINES = _table(b"\n")


def template_words(text: str) -> frozenset[bytes]:
    return frozenset(text.encode().translate(LINES).split())


def word_counts(docs: DataFrame, words: frozenset[bytes]) -> dict[bytes, int]:
    """In how many documents each of the words occurs, over the whole corpus."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch.column(0):
                seen.update(words.intersection((text.as_py() or "").encode().translate(LINES).split()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], ["word", "n"]
        )

    counted = docs.select(F.col("text").cast("string")).mapInArrow(count, "word binary, n bigint")
    total = counted.groupBy("word").agg(F.sum("n").alias("n"))
    # At most as many rows as the templates have words.
    return {bytes(row["word"]): row["n"] for row in total.collect()}


class Templates:
    """An index of the templates by the words of their prefixes."""

    def __init__(self, texts: Mapping[str, str], threshold: float, counts: Mapping[bytes, int]):
        self.words = {name: template_words(text) for name, text in texts.items()}
        every = frozenset().union(*self.words.values())
        if len(every) > MOST_TEMPLATE_WORDS:
            raise ValueError(f"templates have more than {MOST_TEMPLATE_WORDS} words")
        ordered = sorted(every, key=lambda word: (counts.get(word, 0), word))
        self.rank = {word: at for at, word in enumerate(ordered)}
        self.needed = {
            name: max(1, math.ceil(threshold * len(own) - 1e-9)) for name, own in self.words.items()
        }
        self.prefixes: dict[bytes, list[tuple[str, int]]] = defaultdict(list)
        for name, own in self.words.items():
            by_rank = sorted(own, key=self.rank.__getitem__)
            for at, word in enumerate(by_rank[: len(own) - self.needed[name] + 1]):
                self.prefixes[word].append((name, at))
        self.first = frozenset(self.prefixes)

    def match(self, words: frozenset[bytes] | set[bytes]) -> Iterator[tuple[str, float]]:
        """Templates that a block's words contain enough of."""
        known = sorted(words & self.rank.keys(), key=self.rank.__getitem__)
        tried = set()
        for at, word in enumerate(known):
            for name, place in self.prefixes.get(word, ()):
                needed, size = self.needed[name], len(self.words[name])
                if name in tried or len(known) < needed:
                    continue
                tried.add(name)
                # It is the rarest word that both have, so no earlier one is common.
                if min(size - place, len(known) - at) < needed:
                    continue
                common = len(self.words[name] & words)
                if common >= needed:
                    yield name, common / size


class Windows:
    """The windows of a text that hold enough of a template.

    A window is as many words as the template has, repeats included, over the threshold, so
    a notice may have some other words inside. Every window of the text is looked at.
    """

    def __init__(self, texts: Mapping[str, str], telling: Mapping[str, str], threshold: float):
        self.words = {name: template_words(text) for name, text in texts.items()}
        self.telling = {name: template_words(telling.get(name, "")) for name in texts}
        for name, own in self.telling.items():
            if not own <= self.words[name]:
                raise ValueError(f"telling words of {name} are not in its template")
        self.needed = {name: max(1, math.ceil(threshold * len(own) - 1e-9)) for name, own in self.words.items()}
        self.length = {
            name: math.ceil(len(text.encode().translate(LINES).split()) / threshold) for name, text in texts.items()
        }
        self.of: dict[bytes, list[str]] = defaultdict(list)
        for name, own in self.words.items():
            for word in own:
                self.of[word].append(name)

    def match(self, words: list[bytes]) -> Iterator[tuple[str, int, float]]:
        """Template, first word and containment of the best window of every stretch of matches."""
        places: dict[str, list[tuple[int, bytes]]] = defaultdict(list)
        for at, word in enumerate(words):
            for name in self.of.get(word, ()):
                places[name].append((at, word))
        for name, held in places.items():
            telling, needed, size = self.telling[name], self.needed[name], len(self.words[name])
            if len({word for _, word in held}) < needed:
                continue
            inside: Counter[bytes] = Counter()
            first, best, end = 0, (0, 0), -1
            for at, word in held:
                inside[word] += 1
                while held[first][0] <= at - self.length[name]:
                    old = held[first][1]
                    inside[old] -= 1
                    if not inside[old]:
                        del inside[old]
                    first += 1
                if len(inside) < needed or not telling <= inside.keys():
                    continue
                if best[0] and held[first][0] > end:  # a window apart from the last ones
                    yield name, -best[1], best[0] / size
                    best = (0, 0)
                best, end = max(best, (len(inside), -held[first][0])), at
            if best[0]:
                yield name, -best[1], best[0] / size


def _places(words: list[bytes], phrase: tuple[bytes, ...]) -> Iterator[int]:
    at = -1
    try:
        while True:
            at = words.index(phrase[0], at + 1)
            if tuple(words[at : at + len(phrase)]) == phrase:
                yield at
    except ValueError:
        return


def _record(batch: pa.RecordBatch, sizes: list, places: list, matches: list) -> pa.RecordBatch:
    kinds = [
        pa.list_(pa.struct([("word", pa.int64()), ("label", pa.string())])),
        pa.list_(pa.struct([("block", pa.int64()), ("template", pa.string()), ("containment", pa.float64())])),
    ]
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(sizes, pa.int64()), pa.array(places, kinds[0]), pa.array(matches, kinds[1])],
        ["doc_id", "n_words", "places", "matches"],
    )


def scan(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Phrases and template matches of all documents, whole texts.

    Blocks are the lines of a text. Result: doc_id, n_words, ``places`` (start word
    and label of every phrase occurrence, by word) and ``matches`` (line number,
    template and containment of every match). Null and empty texts have none.
    Repeated rows all come back; columns other than doc_id and text are not read.
    """
    named = {name: text for name, text in templates.items() if template_words(text)}
    vocabulary = frozenset().union(*(template_words(text) for text in named.values()))
    index = Templates(named, threshold, word_counts(docs, vocabulary) if named else {})
    wanted = {tuple(phrase.encode().split()): label for phrase, label in phrases.items()}

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, places, matches = [], [], []
            for text in batch.column(1):
                data = (text.as_py() or "").encode().translate(LINES)
                words = data.split()
                own = set(words)
                found = [
                    {"word": at, "label": label}
                    for phrase, label in wanted.items()
                    if own.issuperset(phrase)
                    for at in _places(words, phrase)
                ]
                places.append(sorted(found, key=lambda place: (place["word"], place["label"])))
                matches.append([])
                if not own.isdisjoint(index.first):
                    for number, line in enumerate(data.split(b"\n")):
                        for name, share in index.match(set(line.split())):
                            matches[-1].append({"block": number, "template": name, "containment": share})
                sizes.append(len(words))
            yield _record(batch, sizes, places, matches)

    own = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return own.mapInArrow(look, MATCHES)


def notices(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    phrases: Mapping[str, str] = PHRASES,
    threshold: float = THRESHOLD,
    telling: Mapping[str, str] = TELLING,
) -> DataFrame:
    """As :func:`scan`, but notices are found wherever their lines break, and long lines are
    not one bag of words: blocks are windows of bounded length over the words of the whole
    text, and ``block`` is the number of a window's first word. ``telling`` names words of a
    template that a match must have."""
    named = {name: text for name, text in templates.items() if template_words(text)}
    index = Windows(named, telling, threshold)
    wanted = {tuple(phrase.encode().split()): label for phrase, label in phrases.items()}

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, places, matches = [], [], []
            for text in batch.column(1):
                words = (text.as_py() or "").encode().translate(LINES).split()
                own = set(words)
                found = [
                    {"word": at, "label": label}
                    for phrase, label in wanted.items()
                    if own.issuperset(phrase)
                    for at in _places(words, phrase)
                ]
                places.append(sorted(found, key=lambda place: (place["word"], place["label"])))
                held = sorted(index.match(words), key=lambda match: (match[1], match[0]))
                matches.append([{"block": at, "template": name, "containment": share} for name, at, share in held])
                sizes.append(len(words))
            yield _record(batch, sizes, places, matches)

    own = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return own.mapInArrow(look, MATCHES)


def labelled(found: DataFrame) -> DataFrame:
    """Labels and a score of each document of :func:`scan`.

    The score is 1 with a phrase, else the best containment, else 0.
    """
    by_phrase = F.array_distinct(F.col("places")["label"])
    by_template = F.col("matches")["template"]
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(F.col("places")["word"]).alias("first_word"),
        F.array_max(F.col("places")["word"]).alias("last_word"),
        F.concat_ws(",", F.sort_array(by_phrase)).alias("base_labels"),
        F.concat_ws(",", F.sort_array(F.array_union(by_phrase, by_template))).alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0))
        .otherwise(F.coalesce(F.array_max(F.col("matches")["containment"]), F.lit(0.0)))
        .alias("score"),
    )

"""Near-duplicate texts by improved consistent weighted sampling.

A text is the bag of its five-word shingles, weighed by TF-IDF. Shingles that at least
one in 1,024 documents has are counted exactly over the whole corpus; all rarer ones
share the weight of that frequency, so the table of frequencies has as many rows as
1,024 documents have shingles, however large the corpus is. Consistent weighted
samples of two texts agree as often as their weighted Jaccard similarity. Samples are
grouped into bands; texts that agree on a band are candidates, and the exact weighted
Jaccard similarity of their whole texts decides.

Equal texts, byte by byte, are one node. Within a band's group no pairs are listed: every text is
compared with the group's first one. What fails is compared anew inside its group
if that is small. The texts of all larger groups are joined by their rare shingles,
exactly. Links become classes by passing the smallest label along them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granero.llm.tables import sifted, then_free
from granero.sources.staging import stage

SHINGLE = 5
SIMILARITY = 0.8
# Shingles of a smaller share of documents, or of fewer documents, share one weight.
RARE_SHARE, RARE_LEAST = 1 / 1024, 4
# A shingle that is not rare is in this many documents of some counting task, or more.
LEAST_IN_TASK = 8
SKETCH = 1 << 23
# Pooled random numbers of the samples; a shingle's hash picks among them.
POOL = 1 << 16
NO_ID = -(1 << 63)


@dataclass(frozen=True)
class Bands:
    """Similarity s is found with chance 1 - (1 - s ** rows) ** bands: 0.999 at 0.8."""

    bands: int = 10
    rows: int = 3
    seed: int = 23

    @property
    def samples(self) -> int:
        return self.bands * self.rows


# --- texts to weighted shingles -------------------------------------------------


def _word_bytes() -> bytes:
    table = bytearray(b" " * 256)
    for byte in range(256):
        if byte >= 0x80 or bytes([byte]).isalnum():
            table[byte] = bytes([byte]).lower()[0]
    return bytes(table)


WORD_BYTES = _word_bytes()
BLANK_BYTES = b" \t\n\r\x0b\x0c"


def _kinds() -> bytes:
    """0 for blanks, 1 for signs, 2 for what words are made of."""
    return bytes(0 if byte in BLANK_BYTES else 1 if WORD_BYTES[byte] == 32 else 2 for byte in range(256))


KINDS = _kinds()


def word_bytes(text: str) -> np.ndarray:
    """Lower-cased words with blanks between them.

    Signs at words are blanks. A run of signs between blanks, such as an operator, is
    a word, so texts that differ only in such signs differ.
    """
    raw = text.encode()
    plain = np.frombuffer(raw.translate(WORD_BYTES), np.uint8)
    kinds = np.frombuffer(b"\0" + raw.translate(KINDS) + b"\0", np.uint8)
    begins = np.flatnonzero((kinds[1:] == 1) & (kinds[:-1] == 0)) + 1
    if not len(begins):
        return plain
    others = np.flatnonzero(kinds != 1)
    ends = others[np.searchsorted(others, begins)]
    alone = kinds[ends] == 0
    if not alone.any():
        return plain
    steps = np.zeros(len(kinds), np.int8)
    steps[begins[alone]] = 1
    steps[ends[alone]] = -1
    kept = np.cumsum(steps, dtype=np.int8)[1:-1].astype(bool)
    return np.where(kept, np.frombuffer(raw, np.uint8), plain)


_BASE = 0x9E3779B97F4A7C15 | 1
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
_S29, _S32, _S48 = np.uint64(29), np.uint64(32), np.uint64(48)
_STEP = 1 << 16


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _S29)) * _MIX
    x = (x ^ (x >> _S32)) * _MIX2
    return x ^ (x >> _S29)


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2 ** 64."""

    def up_to(base: int) -> np.ndarray:
        steps = np.full(_STEP, base, np.uint64)
        steps[0] = 1
        return np.cumprod(steps, dtype=np.uint64)

    return up_to(_BASE), up_to(pow(_BASE, -1, 1 << 64))


def word_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word of blank-separated bytes, in order."""
    inside = np.empty(len(data) + 2, bool)
    inside[0] = inside[-1] = False
    np.not_equal(data, 32, out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, stops = edges[0::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    up, down = _powers()
    out, first = [], 0
    while first < len(starts):
        # As many words as fit in one stretch of powers; a longer word is hashed alone.
        begin = int(starts[first])
        last = int(np.searchsorted(stops, begin + _STEP, side="right"))
        if last <= first:
            own = data[begin : int(stops[first])].tobytes()
            out.append(np.array([xxhash.xxh3_64_intdigest(own)], np.uint64))
            first += 1
            continue
        part = data[begin : int(stops[last - 1])]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part.astype(np.uint64) * up[: len(part)], out=sums[1:])
        low, high = starts[first:last] - begin, stops[first:last] - begin
        out.append(mixed((sums[high] - sums[low]) * down[low] + high.astype(np.uint64) - low.astype(np.uint64)))
        first = last
    return np.concatenate(out)


def shingle_hashes(text: str, size: int = SHINGLE) -> np.ndarray:
    """Hashes of all shingles in order, repeated ones included.

    A text of fewer words is one shingle; one of no words has none.
    """
    words = word_hashes(word_bytes(text))
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.zeros(len(words) - size + 1, np.uint64)
    for place in range(size):
        total = total * np.uint64(_BASE) + words[place : len(words) - size + 1 + place]
    return mixed(total + np.uint64(size))


def shingles(text: str, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, sorted, and how often each occurs."""
    return np.unique(shingle_hashes(text, size), return_counts=True)


@dataclass(frozen=True)
class Rarity:
    """IDF of shingles: ``idf`` of the sorted ``names``, ``rare`` of all others."""

    names: np.ndarray
    idf: Rarity
    rare: float

    def of(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self.names):
            return np.full(len(hashes), self.rare)
        at = np.minimum(np.searchsorted(self.names, hashes), len(self.names) - 1)
        return np.where(self.names[at] == hashes, self.idf[at], self.rare)


def weights(hashes: np.ndarray, counts: np.ndarray, rarity: Rarity) -> np.ndarray:
    return counts * rarity.of(hashes)


Bag = tuple[np.ndarray, np.ndarray]


def bag(text: str, idf: Rarity) -> Bag:
    """Distinct shingles and their weights."""
    found, counts = shingles(text)
    return found, weights(found, counts, idf)


def weighted_jaccard(one: Bag, other: Bag) -> float:
    """Sum of the smaller weights over the sum of the larger ones; 0 for texts of no words."""
    _, at, to = np.intersect1d(one[0], other[0], assume_unique=True, return_indices=True)
    common = float(np.minimum(one[1][at], other[1][to]).sum())
    total = float(one[1].sum() + other[1].sum()) - common
    return common / total if total > 0 else 0.0


# --- corpus statistics ----------------------------------------------------------


def _often_in_task(least: int):
    """Shingles that may be in ``least`` documents of a task, with an upper bound of how many.

    Documents are counted in a fixed number of hash buckets. A shingle is listed once
    its bucket has reached the number, so none is missed.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(SKETCH, np.uint32)
        often = np.empty(0, np.uint64)
        found: list[np.ndarray] = []
        waiting = 0
        for batch in batches:
            for text in batch.column(0):
                own = shingle_hashes(text.as_py() or "")
                place = (own & np.uint64(SKETCH - 1)).astype(np.int64)
                held[place] += 1  # once, however often a place is named
                found.append(own[held[place] >= least])
                waiting += len(found[-1])
                if waiting > 1_000_000:
                    often, found, waiting = np.unique(np.concatenate([often, *found])), [], 0
        often = np.unique(np.concatenate([often, *found]))
        if len(often):
            most = held[often & np.uint64(SKETCH - 1)].astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(often.view(np.int64)), pa.array(most)], ["shingle", "most"])

    return listed


def _exactly(names: np.ndarray):
    """In how many documents of a task each of these sorted shingles is."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(names), np.int64)
        there = np.zeros(SKETCH, bool)
        there[(names & np.uint64(SKETCH - 1)).astype(np.int64)] = True
        for batch in batches:
            for text in batch.column(0):
                own = shingle_hashes(text.as_py() or "")
                own = own[there[(own & np.uint64(SKETCH - 1)).astype(np.int64)]]  # a table's look is cheaper than a search
                at = np.minimum(np.searchsorted(names, own), len(names) - 1)
                held[at[names[at] == own]] += 1  # once, however often a place is named
        place = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(place), pa.array(held[place])], ["place", "n"])

    return count


def inverse_frequencies(docs: DataFrame, share: float = RARE_SHARE, least: int = RARE_LEAST) -> Rarity:
    """IDF of all shingles of the column text: ln((1 + N) / (1 + max(df, floor))) + 1.

    ``floor`` is ``share`` of the N documents, or ``least``. A shingle in that many
    documents is in at least floor / tasks of them in some task. Every task lists its own
    shingles of half as many, those whose bounds together reach the floor are counted
    exactly, and the others are rare. As tasks that do not list a shingle hold less than
    half the floor of it, one that is counted has bounds of over half the floor where it is
    listed. So what reaches the driver is bounded by the number of shingles in about
    2 / share documents, however many documents and tasks there are.
    """
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    in_parts = texts.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"))
    total, parts = in_parts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    floor = max(least, int(np.ceil(total * share)))
    rare = float(np.log((1 + total) / (1 + min(floor, total))) + 1)
    # Never more tasks than that, whatever becomes of the parts: coalesce sees to it.
    tasks = max(1, min(parts, floor // LEAST_IN_TASK))
    in_task = floor if tasks == 1 else -(-floor // (2 * tasks))
    few = texts.coalesce(tasks)
    listed = few.mapInArrow(then_free(_often_in_task(in_task)), "shingle bigint, most bigint")
    # Where a shingle is not listed it is in fewer than in_task documents.
    elsewhere = (F.lit(tasks) - F.count(F.lit(1))) * (in_task - 1)
    bounded = listed.groupBy("shingle").agg((F.sum("most") + elsewhere).alias("most"))
    names = bounded.where(F.col("most") >= floor).select("shingle").toArrow().column(0).to_numpy()
    names = np.sort(names.astype(np.int64).view(np.uint64))
    if not len(names):
        return Rarity(names, np.empty(0), rare)
    counted = texts.mapInArrow(then_free(_exactly(names)), "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n"))
    rows = counted.where(F.col("n") >= floor).toArrow()
    place, df = (rows.column(i).to_numpy().astype(np.int64) for i in range(2))
    order = np.argsort(place)
    return Rarity(names[place[order]], np.log((1 + total) / (1 + df[order])) + 1, rare)


# --- samples --------------------------------------------------------------------


class Sampler:
    """Improved consistent weighted sampling (Ioffe).

    Per sample and shingle r and c are gamma(2, 1) and beta is uniform. With
    t = floor(ln w / r + beta), the shingle of the smallest ln c - r (t - beta) - r
    is the sample, together with t.
    """

    def __init__(self, bands: Bands, idf: Rarity):
        rng = np.random.default_rng(bands.seed)
        self.idf = idf
        self.rate = rng.gamma(2.0, 1.0, POOL).astype(np.float32)
        self.log_c = np.log(rng.gamma(2.0, 1.0, POOL)).astype(np.float32)
        self.beta = rng.random(POOL, np.float32)
        self.odd = rng.integers(1 << 62, size=bands.samples, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)

    def samples(self, text: str) -> np.ndarray:
        found, counts = shingles(text)
        if not len(found):
            return np.zeros(0, np.uint64)
        log_w = np.log(weights(found, counts, self.idf)).astype(np.float32)
        own = np.empty(len(self.odd), np.uint64)
        step = max(1, 1_000_000 // len(found))
        for at in range(0, len(self.odd), step):
            odd = self.odd[at : at + step, None]
            pick = found[None, :] * odd
            pick = ((pick ^ (pick >> _S29)) * _MIX >> _S48).astype(np.int64)
            rate, beta = self.rate[pick], self.beta[pick]
            t = np.floor(log_w / rate + beta)
            least = (self.log_c[pick] - rate * (t - beta + 1)).argmin(axis=1)
            line = np.arange(len(least))
            level = t[line, least].astype(np.int64).astype(np.uint64)
            own[at : at + step] = mixed(found[least] + level * np.uint64(_BASE))
        return own


SIGNED = "doc bigint, node bigint, samples array<bigint>"


def signed(docs: DataFrame, idf: Rarity, bands: Bands) -> DataFrame:
    """Samples of every row of (doc, node, text); none without words."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler(bands, idf)
        for batch in batches:
            texts = [text.as_py() or "" for text in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([sampler.samples(text).view(np.int64) for text in texts], pa.list_(pa.int64())),
                ],
                ["doc", "node", "samples"],
            )

    return docs.mapInArrow(then_free(sign), SIGNED)


# --- links ----------------------------------------------------------------------

MEMBERS_IN_TASK = 400
# Times that long lists of texts meet a text before all their pairs do.
HOT_ROUNDS = 6


def band_keys(bands: Bands) -> Column:
    """One hash per band of its samples."""
    return F.array(
        *(
            F.xxhash64(F.lit(band), *(F.col("samples")[band * bands.rows + i] for i in range(bands.rows)))
            for band in range(bands.bands)
        )
    )


def _linked(pairs: DataFrame, texts: DataFrame, idf: Rarity, similarity: float) -> DataFrame:
    """The pairs (a, b) whose whole texts are similar enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, first = None, None
        for batch in batches:
            same = []
            for node, one, other in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3)):
                if node != last:  # pairs of a group's first text come together
                    last, first = node, bag(one.as_py(), idf)
                same.append(weighted_jaccard(first, bag(other.as_py(), idf)) >= similarity)
            yield batch.select([0, 1]).filter(pa.array(same, pa.bool_()))

    pairs = stage(pairs)
    if pairs.isEmpty():
        return pairs
    left = sifted(texts, F.col("node"), pairs.select("a")).select(F.col("node").alias("a"), F.col("text").alias("one"))
    right = sifted(texts, F.col("node"), pairs.select("b")).select(F.col("node").alias("b"), F.col("text").alias("other"))
    return (
        pairs.join(right, "b").join(left, "a").select("a", "b", "one", "other").mapInArrow(then_free(verify), "a bigint, b bigint")
    )


def components(links: DataFrame) -> DataFrame:
    """The smallest node (``label``) that each linked node is connected to.

    Labels move along links until none changes. Links mostly run from a group's
    first text to the others, so few steps are needed; after those, labels are also
    looked up once more per step, so that chains halve. Each step is written out.
    """
    both = stage(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label"))
    labels, steps = stage(labels), 0
    while True:
        far = labels.select(F.col("node").alias("b"), F.col("label").alias("near"))
        heard = both.join(far, "b").select(F.col("a").alias("node"), "near", F.lit(None).cast("bigint").alias("own"))
        own = labels.select("node", F.col("label").alias("near"), F.col("label").alias("own"))
        step = heard.unionByName(own).groupBy("node").agg(F.min("near").alias("label"), F.min("own").alias("was"))
        if steps >= 3:
            # A label is a node itself, so it has a label of its own.
            jump = labels.select(F.col("node").alias("label"), F.col("label").alias("over"))
            step = step.join(jump, "label").select("node", F.least("label", "over").alias("label"), "was")
        step, steps = stage(step), steps + 1
        labels = step.select("node", "label")
        if step.where(F.col("label") != F.col("was")).isEmpty():
            return labels


def _with_labels(members: DataFrame, labels: DataFrame) -> DataFrame:
    named = labels.select(F.col("node").alias("_n"), F.col("label"))
    return members.join(named, F.col("node") == F.col("_n"), "left").withColumn(
        "label", F.coalesce("label", "node")
    ).drop("_n")


def similarities(texts: list[str], idf: Rarity, cells: int = 4_000_000) -> np.ndarray:
    """Weighted Jaccard similarity of all pairs of a small group."""
    found = [shingles(text) for text in texts]
    weighed = [weights(own, counts, idf) for own, counts in found]
    names, times = np.unique(np.concatenate([own for own, _ in found]), return_counts=True)
    names = names[times > 1]
    common = np.zeros((len(texts), len(texts)))
    step = max(1, cells // len(texts))
    for at in range(0, len(names), step):
        part = names[at : at + step]
        table = np.zeros((len(texts), len(part)))
        for row, (own, _) in enumerate(found):
            _, mine, there = np.intersect1d(own, part, assume_unique=True, return_indices=True)
            table[row, there] = weighed[row][mine]
        for row in range(len(texts)):
            common[row, : row + 1] += np.minimum(table[row], table[: row + 1]).sum(axis=1)
    sizes = np.array([own.sum() for own in weighed])
    either = sizes[:, None] + sizes[None, :] - common
    return np.divide(common, either, out=np.zeros_like(common), where=either > 0)


def _inside(idf: Rarity, similarity: float):
    """Links between a small group's members that are not connected yet."""

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node")
        nodes, labels = rows["node"].to_numpy(np.int64), rows["label"].to_numpy(np.int64).copy()
        near = similarities(rows["text"].tolist(), idf) >= similarity
        found: list[tuple[int, int]] = []
        for one, other in zip(*np.nonzero(np.tril(near, -1))):
            if labels[one] != labels[other]:
                found.append((int(nodes[other]), int(nodes[one])))
                labels[labels == labels[one]] = labels[other]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return compare


def _grouped(members: DataFrame) -> DataFrame:
    """Members (key, node, label, ...) of groups with more than one label, with group facts."""
    # Bands differ in what comes first, so a text meets several others of a large group.
    order = (
        F.when(F.col("band") % 3 == 0, F.col("doc"))
        .when(F.col("band") % 3 == 1, F.bitwise_not(F.col("doc")))
        .otherwise(F.xxhash64("node"))
    )
    facts = members.groupBy("key").agg(
        F.min(F.struct(order.alias("order"), "node", "label")).alias("head"),
        F.count(F.lit(1)).alias("size"),
        F.min("label").alias("low"),
        F.max("label").alias("high"),
    )
    apart = facts.where(F.col("low") != F.col("high")).select(
        "key", F.col("head.node").alias("first"), F.col("head.label").alias("first_label"), "size"
    )
    return members.join(apart, "key")


def _to_first(groups: DataFrame) -> DataFrame:
    """Pairs of a group's first text and each other one."""
    other = groups.where(F.col("node") != F.col("first"))
    pair = (F.least("first", "node").alias("a"), F.greatest("first", "node").alias("b"))
    return other.select(*pair).distinct()


def _rare_first(texts: DataFrame, idf: Rarity, similarity: float) -> DataFrame:
    """Of every text (node, text) its rarest shingles: node, total, shingles, rests.

    Shingles have one order for all texts, the rare ones of these texts first. What two
    similar texts have in common weighs at least ``similarity`` times either, so the first
    shingle that both have is one with at least that share of both texts from it on
    (``rests``). Only those shingles are listed. Texts of no words are left out.
    """
    rarity = inverse_frequencies(texts.select("text"))

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found, own = bag(text.as_py(), idf)
                if not len(found):
                    continue
                order = np.lexsort((found, -rarity.of(found)))
                rest = own[order][::-1].cumsum()[::-1]
                rest = rest[rest >= similarity * rest[0] * (1 - 1e-9)]
                rows.append((node, float(rest[0]), found[order[: len(rest)]].view(np.int64), rest))
            nodes, totals, names, rests = zip(*rows) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(nodes, pa.int64()),
                    pa.array(totals, pa.float64()),
                    pa.array(names, pa.list_(pa.int64())),
                    pa.array(rests, pa.list_(pa.float64())),
                ],
                ["node", "total", "shingles", "rests"],
            )

    schema = "node bigint, total double, shingles array<bigint>, rests array<double>"
    return texts.select("node", "text").mapInArrow(then_free(listed), schema)


def _may_be_near(one: str, other: str, similarity: float) -> Column:
    """Whether texts can be similar if the shingle they met at is the first that both have."""
    least = similarity / (1 + similarity) * (1 - 1e-9)
    return F.least(f"{one}.rest", f"{other}.rest") >= least * (F.col(f"{one}.total") + F.col(f"{other}.total"))


def _lists(postings: DataFrame, turn: int) -> DataFrame:
    """Postings of shingles that texts of different labels have, with one text of each list.

    ``postings`` is a stored table (node, label, shingle, rest, total).
    """
    facts = postings.groupBy("shingle").agg(
        F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("order"), "node", "label", "rest", "total")).alias("head"),
        F.count(F.lit(1)).alias("size"),
        F.min("label").alias("low"),
        F.max("label").alias("high"),
    )
    return postings.join(facts.where(F.col("low") != F.col("high")).drop("low", "high"), "shingle")


def _all_pairs(lists: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of different labels that may be near, of every list.

    A list of more than ``MEMBERS_IN_TASK`` texts is dealt into parts and every two of
    them meet in a cell of their own.
    """
    parts = F.ceil(F.col("size") / MEMBERS_IN_TASK)
    dealt = lists.drop("head").withColumn("part", F.pmod(F.xxhash64("node", F.lit("part")), parts))
    left = dealt.withColumn("row", F.col("part")).withColumn("column", F.explode(F.sequence("part", parts - 1)))
    right = dealt.withColumn("column", F.col("part")).withColumn("row", F.explode(F.sequence(F.lit(0).cast("bigint"), "part")))
    left, right = left.alias("l"), right.alias("r")
    same = [F.col(f"l.{name}") == F.col(f"r.{name}") for name in ("shingle", "row", "column")]
    once = (F.col("l.row") != F.col("l.column")) | (F.col("l.node") < F.col("r.node"))
    apart = (F.col("l.label") != F.col("r.label")) & once & _may_be_near("l", "r", similarity)
    return left.join(right, same[0] & same[1] & same[2] & apart).select(
        F.least("l.node", "r.node").alias("a"), F.greatest("l.node", "r.node").alias("b")
    ).distinct()


def _among(
    hot: DataFrame, texts: DataFrame, links: DataFrame, labels: DataFrame, idf: Rarity, similarity: float
) -> DataFrame:
    """``links`` and those between all similar texts of ``hot`` (node) that they do not connect."""
    own = stage(sifted(texts, F.col("node"), hot).join(hot, "node", "left_semi"))
    # Labels meet texts, not postings.
    named = _with_labels(stage(_rare_first(own, idf, similarity)), labels)
    each = F.explode(F.arrays_zip(F.col("shingles").alias("shingle"), F.col("rests").alias("rest")))
    postings = stage(named.select("node", "label", "total", each.alias("p")).select("node", "label", "total", "p.*"))
    # Long lists shrink first: their texts meet one of them, as in bands, while that connects any.
    for turn in range(HOT_ROUNDS + 1):
        lists = stage(_lists(postings, turn))
        long = lists.where(F.col("size") > MEMBERS_IN_TASK).alias("t")
        if turn == HOT_ROUNDS or long.isEmpty():
            break
        meets = (F.col("t.label") != F.col("t.head.label")) & _may_be_near("t", "t.head", similarity)
        pairs = long.where(meets).select(
            F.least("t.node", "t.head.node").alias("a"), F.greatest("t.node", "t.head.node").alias("b")
        )
        met = stage(_linked(pairs.distinct(), own, idf, similarity))
        if met.isEmpty():
            break
        links = stage(links.unionByName(met).distinct())
        # Lists of texts that are all connected by now do not come again.
        left = lists.select("node", "shingle", "rest", "total")
        postings = stage(_with_labels(left, components(links)).select("node", "label", "shingle", "rest", "total"))
    met = _linked(_all_pairs(lists, similarity), own, idf, similarity)
    return stage(links.unionByName(met).distinct())


def near_links(
    nodes: DataFrame, texts: DataFrame, idf: Rarity, bands: Bands = Bands(), similarity: float = SIMILARITY
) -> DataFrame:
    """Links (a, b) that connect similar texts.

    ``nodes`` (node, doc, samples) and ``texts`` (node, text) are stored tables. In a
    band's group every text meets the group's first. In groups whose texts are then
    not all connected, small ones are compared inside one task, all unconnected pairs
    of at most ``MEMBERS_IN_TASK`` texts. The texts of all larger groups are joined
    by their rare shingles, which finds every similar pair of them that is not connected.
    """
    samples = nodes.where(F.size("samples") > 0)
    members = samples.select(
        "node", "doc", F.col("node").alias("label"), F.posexplode(band_keys(bands)).alias("band", "key")
    )
    groups = stage(_grouped(members))
    links = stage(_linked(_to_first(groups), texts, idf, similarity))
    labels = components(links)
    known = groups.select("key", "node", "doc", "band")
    unlinked = stage(_grouped(_with_labels(known, labels)))
    small = unlinked.where(F.col("size") <= MEMBERS_IN_TASK)
    # Bands often group the same texts; one of those groups is enough.
    sets = small.groupBy("key").agg(F.sort_array(F.collect_list("node")).alias("all"))
    once = sets.groupBy("all").agg(F.min("key").alias("key")).select("key")
    compared = stage(small.select("key", "node", "label").join(once, "key"))
    inside = (
        compared.join(sifted(texts, F.col("node"), compared.select("node")), "node")
        .groupBy("key").applyInPandas(_inside(idf, similarity), "a bigint, b bigint")
    )
    links = stage(links.unionByName(inside).distinct())
    hot = stage(unlinked.where(F.col("size") > MEMBERS_IN_TASK).select("node").distinct())
    if hot.isEmpty():
        return links
    return _among(hot, texts, links, components(links), idf, similarity)


def near_duplicates(docs: DataFrame, bands: Bands = Bands(), similarity: float = SIMILARITY) -> DataFrame:
    """Class of every document: doc_id, class_id, kept, n_links.

    ``class_id`` is the smallest doc_id of the class, ``kept`` marks the document that
    stands for it (the smallest text hash, if rows share that id; equal rows are all
    marked). ``n_links`` counts the spanning links of the document's text: verified, but
    only those found on the way to connecting its class, so in a large class far fewer
    than its similar texts. Equal texts are one text, a null one is empty; texts of no words
    are near no other text. Words are compared without the signs at them, but a run of signs
    between blanks is a word, so texts that differ only there are as far apart as by words.
    Null ids are smallest. Columns other than doc_id and text are not read. An empty
    table gives an empty result.
    """
    return _classes(docs, bands, similarity).select(
        F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"),
        F.when(F.col("class") != NO_ID, F.col("class")).alias("class_id"),
        "kept",
        "n_links",
    )


def _identified(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("node"), text.alias("text")
    )


def _classes(docs: DataFrame, bands: Bands, similarity: float) -> DataFrame:
    given = _identified(docs)
    idf = inverse_frequencies(given.select("text"))
    rows = stage(signed(given, idf, bands))
    nodes = stage(rows.groupBy("node").agg(F.min("doc").alias("doc"), F.first("samples").alias("samples")))
    # Only texts that some band groups with another are fetched.
    keyed = nodes.where(F.size("samples") > 0).select("node", F.explode(band_keys(bands)).alias("key"))
    met = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("key")
    grouped = stage(keyed.join(met, "key", "left_semi").select("node").distinct())
    wanted = stage(sifted(nodes, F.col("node"), grouped).join(grouped, "node", "left_semi"))
    near = sifted(given, F.col("node"), wanted.select("node"))
    # Repeated rows go first, by the keys of the join, so that texts are shuffled once.
    texts = stage(
        near.dropDuplicates(["doc", "node"])
        .join(wanted.select(F.col("node").alias("_n"), F.col("doc").alias("_d")), (F.col("doc") == F.col("_d")) & (F.col("node") == F.col("_n")))
        .select("node", "text")
    )
    links = near_links(wanted, texts, idf, bands, similarity)
    labels = components(links)
    degrees = (
        links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    )
    named = _with_labels(nodes.drop("samples"), labels)
    heads = named.groupBy("label").agg(F.min(F.struct("doc", "node")).alias("head"))
    known = stage(
        named.join(heads, "label").join(degrees, "node", "left").select("node", "head", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    )
    return rows.select("doc", "node").join(known, "node").select(
        "doc",
        "node",
        F.col("head.doc").alias("class"),
        ((F.col("doc") == F.col("head.doc")) & (F.col("node") == F.col("head.node"))).alias("kept"),
        "n_links",
    )


def one_per_class(docs: DataFrame, bands: Bands = Bands(), similarity: float = SIMILARITY) -> DataFrame:
    """The documents without near duplicates: one row per class, with all its columns.

    The document of the smallest doc_id stays, a null id before all others; of rows of
    that class that share it the one of the smallest text hash, and of equal ones any. A
    null text counts as empty and stays null. An empty table gives an empty result.
    """
    kept = _classes(docs, bands, similarity).where("kept").select("doc", "node").distinct()
    names = docs.columns
    nested = docs.select(
        F.struct(*(F.col(f"`{name}`") for name in names)).alias("_row"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("_doc"),
        F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("_node"),
    )
    return (
        nested.join(kept, (F.col("_doc") == F.col("doc")) & (F.col("_node") == F.col("node")))
        .dropDuplicates(["_doc", "_node"])
        .select("_row.*")
    )

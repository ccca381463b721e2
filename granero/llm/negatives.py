"""Hard negatives with a multiway tree of split points.

Scores are inner products of whole-number vectors. One more component gives all
vectors the length of the longest one, and then a score is a distance: the larger
the score, the nearer, and a window of scores is an annulus around the anchor. A node
of the tree has several split points far from each other; a vector belongs to the
nearest one, whose subtree's border planes lie between the points. For every two split
points the node stores the least and the greatest distance from one to the vectors
below the other. An anchor knows its distance to a split point, so its annuli can only
hold vectors in a range of distances from that point, and a sibling whose stored range
misses it for all annuli is left out with everything below. What is left are leaves,
whose vectors are scored exactly.

The tree is grown on a bounded sample. All vectors are routed to its leaves and its
ranges are taken over all of them, so nothing is lost. The sample also gives every
window a score that its last wanted row reaches at least, which makes annuli thin.
Equal vectors of one label are searched once, under their smallest ids.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granero.sources.staging import stage

# Beyond any score.
FAR = 1 << 62
RESULT = (
    "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
)


@dataclass(frozen=True)
class TreePolicy:
    """``sample`` vectors at most are fitted on and carried to tasks, whatever the table's size.

    A node has up to ``fanout`` split points, chosen greedily among ``tries`` times as
    many random vectors; nodes of up to ``leaf`` sampled vectors are leaves. A task
    scores at most about ``rows_per_task`` vectors for ``queries_per_task`` anchors.
    """

    sample: int = 20_000
    fanout: int = 16
    tries: int = 3
    leaf: int = 128
    rows_per_task: int = 10_000
    queries_per_task: int = 20_000
    seed: int = 31


@dataclass(frozen=True)
class Ask:
    """What is mined for every anchor; windows are in whole percent of the positive's score."""

    positives: int = 5
    negatives: int = 3
    least_percent: int = 50
    most_percent: int = 95
    scale: int = 256

    def __post_init__(self):
        if not 0 <= self.least_percent <= self.most_percent <= 100:
            raise ValueError("percents must be ordered and within 0 and 100")


# --- scores and distances ---------------------------------------------------------


def products(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of two whole-number matrices.

    By Cauchy and Schwarz no partial sum exceeds the product of the longest rows, so
    the fastest number type is chosen that holds all whole numbers up to there.
    """
    longest = [math.sqrt(max(np.einsum("ij,ij->i", m.astype(np.float64), m.astype(np.float64)), default=0.0)) for m in (one, other)]
    bound = longest[0] * longest[1] * 1.01
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64
    return one.astype(kind) @ other.astype(kind).T


@dataclass(frozen=True)
class Space:
    """Distances between vectors of at most the length ``most``."""

    most: float

    @property
    def slack(self) -> float:
        """More than rounding can move a distance; only ever keeps more."""
        return 1e-6 * self.most

    def lift(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors with one more component, all of length ``most``."""
        own = vectors.astype(np.float64)
        rest = np.sqrt(np.maximum(0.0, self.most**2 - np.einsum("ij,ij->i", own, own)))
        return np.column_stack([own, rest])

    def between(self, points: np.ndarray, lifted: np.ndarray) -> np.ndarray:
        """Distances of all points (any length) to all lifted vectors."""
        squares = np.einsum("ij,ij->i", points, points)[:, None] + self.most**2
        return np.sqrt(np.maximum(0.0, squares - 2 * (points @ lifted.T)))

    def at_score(self, anchors: np.ndarray, scores: np.ndarray) -> np.ndarray:
        """The distance at which a vector has such a score with its anchor; scores are (anchors, windows)."""
        squares = np.einsum("ij,ij->i", anchors, anchors)[:, None] + self.most**2
        return np.sqrt(np.maximum(0.0, squares - 2.0 * scores))


# --- the tree ---------------------------------------------------------------------


@dataclass
class Node:
    """Split points and what is below each: a node's number, or ~number of a leaf.

    Child i has the leaves from ``starts[i]`` to before ``starts[i + 1]``.
    """

    points: np.ndarray
    children: list[int]
    starts: list[int]
    slot: int


class Tree:
    """Leaves are numbered from left to right, so neighbours are close."""

    def __init__(self, space: Space, sample: np.ndarray, policy: TreePolicy):
        self.space, self.nodes, self.leaves, self.slots = space, [], 0, 0
        self.root = self._grow(space.lift(sample), policy, np.random.default_rng(policy.seed))
        # For every split point and sibling the distances to what is below the sibling.
        self.low = np.full(self.slots, np.inf)
        self.high = np.full(self.slots, -np.inf)

    def _split_points(self, points: np.ndarray, policy: TreePolicy, rng: np.random.Generator) -> np.ndarray:
        """Points far from each other: each next one is the farthest from those chosen."""
        tried = points[rng.choice(len(points), min(len(points), policy.fanout * policy.tries), replace=False)]
        chosen, nearest = [0], self.space.between(tried[:1], tried)[0]
        while len(chosen) < policy.fanout and nearest.max() > self.space.slack:
            chosen.append(int(nearest.argmax()))
            nearest = np.minimum(nearest, self.space.between(tried[chosen[-1:]], tried)[0])
        return tried[chosen]

    def _grow(self, points: np.ndarray, policy: TreePolicy, rng: np.random.Generator) -> int:
        if len(points) > policy.leaf:
            splits = self._split_points(points, policy, rng)
            own = self.space.between(points, splits).argmin(axis=1)
            if len(np.unique(own)) > 1:
                number, node = len(self.nodes), Node(splits, [], [self.leaves], self.slots)
                self.nodes.append(node)
                self.slots += len(splits) ** 2
                for i in range(len(splits)):
                    node.children.append(self._grow(points[own == i], policy, rng))
                    node.starts.append(self.leaves)
                return number
        self.leaves += 1
        return ~(self.leaves - 1)

    def route(self, lifted: np.ndarray) -> np.ndarray:
        """The leaf of every vector."""
        leaf = np.zeros(len(lifted), np.int64)
        todo = [(self.root, np.arange(len(lifted)))]
        while todo:
            number, rows = todo.pop()
            if number < 0:
                leaf[rows] = ~number
            elif len(rows):
                node = self.nodes[number]
                own = self.space.between(lifted[rows], node.points).argmin(axis=1)
                todo.extend((child, rows[own == i]) for i, child in enumerate(node.children))
        return leaf

    def ranges(self, lifted: np.ndarray, leaf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and greatest distance per slot of vectors that lie in these leaves."""
        low, high = np.full(self.slots, np.inf), np.full(self.slots, -np.inf)
        order = np.argsort(leaf, kind="stable")
        lifted, leaf = lifted[order], leaf[order]
        for node in self.nodes:
            width = len(node.children)
            bounds = np.searchsorted(leaf, node.starts)
            if bounds[0] == bounds[-1]:
                continue
            far = self.space.between(lifted[bounds[0] : bounds[-1]], node.points)
            for child in range(width):
                below = far[bounds[child] - bounds[0] : bounds[child + 1] - bounds[0]]
                if len(below):
                    slots = node.slot + np.arange(width) * width + child
                    low[slots], high[slots] = below.min(axis=0), below.max(axis=0)
        return low, high

    def survivors(self, anchors: np.ndarray, near: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Which leaves may hold vectors in an annulus: (anchors, leaves).

        ``anchors`` have a last component of 0; ``near`` and ``far`` are the annuli of
        each, (anchors, windows). An annulus of ``near`` above ``far`` holds nothing.
        """
        alive = np.zeros((len(anchors), self.leaves), bool)
        slack = self.space.slack
        todo = [(self.root, np.arange(len(anchors)))]
        while todo:
            number, own = todo.pop()
            if number < 0:
                alive[own, ~number] = True
                continue
            node = self.nodes[number]
            width = len(node.children)
            to_points = self.space.between(anchors[own], node.points)[:, None, :]
            least = np.maximum(to_points - far[own][:, :, None], near[own][:, :, None] - to_points)
            most = to_points + far[own][:, :, None]
            slots = slice(node.slot, node.slot + width * width)
            low, high = self.low[slots].reshape(width, width), self.high[slots].reshape(width, width)
            # A child stays if one annulus meets its ranges from all split points.
            kept = np.ones((*least.shape[:2], width), bool)
            for point in range(width):
                kept &= (least[:, :, point, None] <= high[point] + slack) & (most[:, :, point, None] >= low[point] - slack)
            kept = kept.any(axis=1)
            todo.extend((child, own[kept[:, i]]) for i, child in enumerate(node.children) if kept[:, i].any())
        return alive


# --- scoring ----------------------------------------------------------------------


def unpacked(column) -> np.ndarray:
    """A matrix from a column of little-endian 32-bit vectors."""
    rows = list(column)
    return np.frombuffer(b"".join(rows), "<i4").reshape(len(rows), -1)


def raised(
    scores: np.ndarray, other_label: np.ndarray, least: np.ndarray, most: np.ndarray, k: int, same: bool
) -> np.ndarray:
    """Windows' lower ends, raised to what the k best of the given rows reach in them."""
    wanted = ~other_label if same else other_label
    out = least.copy()
    if scores.shape[1] < k:
        return out
    for window in range(least.shape[1]):
        inside = wanted & (scores >= least[:, window, None]) & (scores <= most[:, window, None])
        own = np.where(inside, scores, scores.dtype.type(-FAR))
        kth = np.partition(own, own.shape[1] - k, axis=1)[:, own.shape[1] - k]
        found = kth > -FAR
        out[found, window] = kth[found].astype(np.int64)
    return out


def first_of_each(group: np.ndarray, score: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best rows of every group, ties to the smaller id."""
    order = np.lexsort((first, -score, group))
    starts = np.flatnonzero(np.diff(group[order], prepend=-1))
    place = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[place < k]


def _windows(column, width: int, empty: int) -> np.ndarray:
    """Lists of windows as a matrix, filled up with ``empty``."""
    out = np.full((len(column), width), empty, np.int64)
    for row, own in enumerate(column):
        out[row, : len(own)] = own
    return out


def _scored(k: int, same: bool, cells: int = 4_000_000):
    """The k best rows of a block in every window of the queries that visit it."""

    def best(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(rows) and len(queries):
            vectors, asked = unpacked(rows["vector"]), unpacked(queries["vector"])
            first, labels, ids = (rows[name].to_numpy() for name in ("first", "label", "ids"))
            own_labels, names = queries["label"].to_numpy(), queries["query"].to_numpy()
            width = max(len(own) for own in queries["least"])
            least, most = _windows(queries["least"], width, 1), _windows(queries["most"], width, 0)
            masks = [np.frombuffer(mask, np.uint8) for mask in queries["leaves"]]
            visits = np.unpackbits(np.stack(masks), axis=1).astype(bool)
            place = rows["place"].to_numpy()
            step = max(1, cells // len(rows))
            for at in range(0, len(queries), step):
                part = slice(at, at + step)
                scores = products(asked[part], vectors)
                fits = visits[part][:, place] & ((own_labels[part, None] == labels) == same)
                lowest = np.where(least[part] <= most[part], least[part], FAR).min(axis=1)
                fits &= (scores >= lowest[:, None]) & (scores <= most[part].max(axis=1)[:, None])
                query, row = np.nonzero(fits)
                score = scores[query, row].astype(np.int64)
                for window in range(width):
                    inside = (score >= least[part][query, window]) & (score <= most[part][query, window])
                    q, r, s = query[inside], row[inside], score[inside]
                    kept = first_of_each(q, s, first[r], k)
                    found.append(
                        pd.DataFrame({"query": names[part][q[kept]], "window": window, "score": s[kept], "ids": ids[r[kept]]})
                    )
        if found:
            return pd.concat(found, ignore_index=True)
        return pd.DataFrame(columns=["query", "window", "score", "ids"], dtype=object)

    return best


# --- the search on Spark ----------------------------------------------------------


@dataclass
class Index:
    """The routed rows of a table, the tree with its ranges, and the sample."""

    tree: Tree
    rows: DataFrame  # place, block, parts, key, first, ids, label, vector
    blocks: list[tuple[int, int, int]]  # first leaf, leaf after the last, parts
    sample: np.ndarray
    sample_labels: np.ndarray
    policy: TreePolicy


def packed(column: pa.Array) -> tuple[np.ndarray, list[bytes]]:
    """A list column as a matrix, and its rows as little-endian 32-bit bytes."""
    matrix = column.flatten().to_numpy().astype("<i4").reshape(len(column), -1)
    return matrix, [row.tobytes() for row in matrix]


def blocks_of(sizes: np.ndarray, rows_per_task: int) -> list[tuple[int, int, int]]:
    """Neighbouring leaves of at most so many rows; a larger leaf is dealt into parts."""
    out, start, held = [], 0, 0
    for leaf, size in enumerate(sizes.tolist()):
        if leaf > start and held + size > rows_per_task:
            out.append((start, leaf, max(1, -(-held // rows_per_task))))
            start, held = leaf, 0
        held += size
    out.append((start, len(sizes), max(1, -(-held // rows_per_task))))
    return out


def build(known: DataFrame, policy: TreePolicy = TreePolicy()) -> Index:
    """Index of a stored table (key, label, v array<int>, ids, first); all v have one length."""
    spark = known.sparkSession
    squares = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows, longest = known.agg(F.count(F.lit(1)), F.max(squares)).first()
    share = min(1.0, policy.sample / rows)
    chosen = F.pmod(F.xxhash64("key", F.lit(policy.seed)), F.lit(1 << 30)) <= int(share * (1 << 30))
    fitted = known.where(chosen).select("v", "label").toArrow()
    sample, _ = packed(fitted.column(0).combine_chunks())
    tree = Tree(Space(max(1.0, math.sqrt(longest))), sample, policy)
    schema = "leaf bigint, key binary, first bigint, ids array<bigint>, label bigint, vector binary"

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors, data = packed(batch.column(4))
            leaf = tree.route(tree.space.lift(vectors))
            columns = [pa.array(leaf), *batch.columns[:4], pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["leaf", "key", "first", "ids", "label", "vector"])

    routed = stage(known.select("key", "first", "ids", "label", "v").mapInArrow(route, schema))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(tree.slots, np.inf), np.full(tree.slots, -np.inf)
        sizes = np.zeros(tree.leaves, np.int64)
        for batch in batches:
            leaf = batch.column(1).to_numpy()
            own_low, own_high = tree.ranges(tree.space.lift(unpacked(batch.column(0).to_pylist())), leaf)
            np.minimum(low, own_low, out=low)
            np.maximum(high, own_high, out=high)
            sizes += np.bincount(leaf, minlength=tree.leaves)
        slots, leaves = np.flatnonzero(high >= 0), np.flatnonzero(sizes)
        columns = [
            np.concatenate([slots, ~leaves]),
            np.concatenate([low[slots], np.zeros(len(leaves))]),
            np.concatenate([high[slots], np.zeros(len(leaves))]),
            np.concatenate([np.zeros(len(slots), np.int64), sizes[leaves]]),
        ]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["slot", "low", "high", "n"])

    measured = routed.select("vector", "leaf").mapInArrow(measure, "slot bigint, low double, high double, n bigint")
    # One row per slot and leaf of the tree, whose size the sample bounds.
    facts = measured.groupBy("slot").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")).collect()
    sizes = np.zeros(tree.leaves, np.int64)
    for fact in facts:
        if fact["slot"] < 0:
            sizes[~fact["slot"]] = fact["n"]
        else:
            tree.low[fact["slot"]], tree.high[fact["slot"]] = fact["low"], fact["high"]
    blocks = blocks_of(sizes, policy.rows_per_task)
    places = [(leaf, block, leaf - start, parts) for block, (start, stop, parts) in enumerate(blocks) for leaf in range(start, stop)]
    table = spark.createDataFrame(places, "leaf bigint, block int, place int, parts int")
    return Index(
        tree, routed.join(F.broadcast(table), "leaf"), blocks, sample, fitted.column(1).to_numpy().astype(np.int64), policy
    )


def search(index: Index, queries: DataFrame, k: int, same: bool) -> DataFrame:
    """The k best rows in every window: query, window, found (array of (down, id), best first).

    ``queries`` is a stored table (query, label, v, least array<bigint>, most array<bigint>);
    window i holds the scores from least[i] to most[i]. Rows of the query's own label
    are searched, or (not ``same``) those of all other labels. ``down`` is the negated
    score; ties go to the smaller id. Windows without rows are not in the result.
    """
    tree, policy, blocks = index.tree, index.policy, index.blocks
    sample, sample_labels = index.sample, index.sample_labels

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["query", "label", "vector", "least", "most", "block", "part", "leaves"]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                own = batch.slice(at, 256)
                vectors, data = packed(own.column(2))
                given = own.column(3).to_pylist()
                width = max(len(x) for x in given)
                if not width:
                    continue
                least, most = _windows(given, width, 1), _windows(own.column(4).to_pylist(), width, 0)
                labels = own.column(1).to_numpy().astype(np.int64)
                least = raised(products(vectors, sample), labels[:, None] != sample_labels, least, most, k, same)
                anchors = np.column_stack([vectors, np.zeros(len(vectors))])
                empty = least > most
                near = np.where(empty, np.inf, tree.space.at_score(anchors, most))
                far = np.where(empty, -np.inf, tree.space.at_score(anchors, least))
                alive = tree.survivors(anchors, near, far)
                rows: list[tuple] = []
                for block, (start, stop, parts) in enumerate(blocks):
                    here = alive[:, start:stop]
                    masks = np.packbits(here, axis=1)
                    for i in np.flatnonzero(here.any(axis=1)).tolist():
                        rows.extend((i, block, part, masks[i].tobytes()) for part in range(parts))
                if rows:
                    places, numbers, parts, masks = zip(*rows)
                    taken = pa.array(places)
                    yield pa.RecordBatch.from_arrays(
                        [
                            own.column(0).take(taken),
                            own.column(1).take(taken),
                            pa.array(data, pa.binary()).take(taken),
                            pa.array(list(least), pa.list_(pa.int64())).take(taken),
                            pa.array(list(most), pa.list_(pa.int64())).take(taken),
                            pa.array(numbers, pa.int32()),
                            pa.array(parts, pa.int32()),
                            pa.array(masks, pa.binary()),
                        ],
                        names,
                    )

    query_parts = max(1, -(-queries.count() // policy.queries_per_task))
    visits = (
        queries.select("query", "label", "v", "least", "most")
        .mapInArrow(
            visit,
            "query binary, label bigint, vector binary, least array<bigint>, most array<bigint>, "
            "block int, part int, leaves binary",
        )
        .withColumn("q", F.pmod(F.xxhash64("query"), F.lit(query_parts)))
    )
    rows = index.rows.withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int")).withColumn(
        "q", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(query_parts - 1).cast("bigint")))
    )
    keys = ["block", "part", "q"]
    wanted = rows.select(*keys, "place", "first", "ids", "label", "vector")
    hits = (
        wanted.groupBy(*keys)
        .cogroup(visits.groupBy(*keys))
        .applyInPandas(_scored(k, same), "query binary, window int, score bigint, ids array<bigint>")
    )
    by_window = Window.partitionBy("query", "window").orderBy(F.desc("score"), F.col("ids")[0])
    down = (-F.col("score")).alias("down")
    each = F.transform("ids", lambda own: F.struct(down, own.alias("id")))
    best = hits.withColumn("_place", F.row_number().over(by_window)).where(F.col("_place") <= k)
    return best.groupBy("query", "window").agg(
        F.slice(F.array_sort(F.flatten(F.collect_list(each))), 1, k).alias("found")
    )


# --- mining -----------------------------------------------------------------------


def quantised(vectors: DataFrame, is_anchor: Column, ask: Ask) -> DataFrame | None:
    """One row per id: vec_id, asks, label, v, key; None if no vector can take part."""
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & fine
    given = vectors.where(good & (F.size("embedding") > 0))
    lengths = given.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return None
    # Scores times 100 still fit 64 bits.
    most = float(min(math.isqrt(((1 << 63) - 1) // (100 * lengths["d"])), (1 << 31) - 1))
    scaled = F.transform(
        "embedding",
        lambda x: F.floor(F.greatest(F.least(x.cast("double") * ask.scale, F.lit(most)), F.lit(-most))).cast("int"),
    )
    rows = given.where(F.size("embedding") == lengths["d"]).select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.struct(F.col("label").cast("bigint").alias("label"), scaled.alias("v")).alias("row"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    )
    once = rows.groupBy("vec_id").agg(F.min("row").alias("row"), F.max("asks").alias("asks")).select("vec_id", "asks", "row.*")
    # Rows of equal label and vector share a key of 128 bits.
    name = F.concat_ws(",", F.col("label").cast("string"), F.transform("v", lambda x: x.cast("string")))
    return once.withColumn("key", F.unhex(F.md5(name)))


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, ask: Ask = Ask(), policy: TreePolicy = TreePolicy()
) -> DataFrame:
    """For each anchor and each of its positives, the best rows of other labels in the positive's window.

    ``vectors`` has vec_id, embedding and label; other columns are read only by
    ``is_anchor``, so their names do not matter. A component x counts as
    floor(scale * x). An anchor's positives are its best other rows of its label; a
    negative's score is from ``least_percent`` to ``most_percent`` of the positive's,
    bounds included, so a negative positive score has no negatives. Higher scores come
    first, ties go to the smaller vec_id; ``rank`` runs from 1. Every row that takes
    part can be found; the result is exact.

    Rows with a null id, label or vector, a null or non-finite component, or a length
    other than the most frequent one take no part. Of several rows with one id the
    least by label and vector counts, so repeated rows count once. Components so large
    that scores would not fit 64 bits are held at the greatest ones that do. Anchors
    without a positive or a negative are not in the result; an empty table gives an
    empty one.
    """
    found = quantised(vectors, is_anchor, ask)
    if found is None:
        return vectors.sparkSession.createDataFrame([], RESULT)
    rows = stage(found)
    keep = max(ask.positives + 1, ask.negatives)
    # The rank filter is also applied before the shuffle, so copies do not meet in one task.
    copies = Window.partitionBy("key").orderBy("vec_id")
    few = rows.withColumn("_copy", F.row_number().over(copies)).where(F.col("_copy") <= keep)
    known = few.groupBy("key", "label", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    index = build(stage(known.withColumn("first", F.col("ids")[0])), policy)

    anchors = rows.where("asks").select(F.col("vec_id").alias("anchor_id"), "key")
    asked = stage(rows.where("asks").select(F.col("key").alias("query"), "label", "v").distinct())
    everything = [F.array(F.lit(edge).cast("bigint")).alias(name) for edge, name in ((-FAR, "least"), (FAR, "most"))]
    near = search(index, asked.select("*", *everything), ask.positives + 1, True).select(
        "query",
        F.col("found").alias("positives"),
        F.filter(F.array_distinct(F.transform("found", lambda x: -x["down"])), lambda s: s >= 0).alias("scores"),
    )
    near = stage(near)
    windowed = near.join(asked, "query").select(
        "query",
        "label",
        "v",
        F.expr(f"transform(scores, s -> ({ask.least_percent} * s + 99) div 100)").alias("least"),
        F.expr(f"transform(scores, s -> ({ask.most_percent} * s) div 100)").alias("most"),
    )
    hard = search(index, stage(windowed), ask.negatives, False)
    # An anchor's class has few positives and windows: one row holds them all.
    by_class = hard.groupBy("query").agg(F.map_from_entries(F.collect_list(F.struct("window", "found"))).alias("negatives"))
    answers = near.join(by_class, "query")
    others = F.filter("positives", lambda x: x["id"] != F.col("anchor_id"))
    pairs = (
        anchors.join(answers, F.col("key") == F.col("query"))
        .select("anchor_id", "scores", "negatives", F.explode(F.slice(others, 1, ask.positives)).alias("p"))
        .withColumn("positive_score", -F.col("p.down"))
    )
    window = (F.array_position("scores", F.col("positive_score")) - 1).cast("int")
    return pairs.select(
        "anchor_id",
        F.col("p.id").alias("positive_id"),
        "positive_score",
        F.posexplode(F.try_element_at("negatives", window)).alias("place", "n"),
    ).select(
        "anchor_id",
        "positive_id",
        (F.col("place") + 1).cast("int").alias("rank"),
        F.col("n.id").alias("negative_id"),
        "positive_score",
        (-F.col("n.down")).alias("negative_score"),
    )

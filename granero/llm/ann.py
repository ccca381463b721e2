"""Approximate nearest neighbours with a forest of random-projection trees.

The forest is grown on a bounded sample; every vector of the table is then routed
to one leaf per tree. A query searches all trees through one priority queue: the
node whose worst margin on the way down is best is opened next, until the leaves
found hold enough vectors. The leaves' vectors are reranked by exact products.

Equal vectors are searched once. Each distinct vector keeps its smallest ids, as
many as a query can return, so large groups of copies cost no more than one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from granero.sources.staging import stage


@dataclass(frozen=True)
class ForestPolicy:
    """``sample`` rows at most are fitted on, whatever the table's size.

    ``search_share`` of the vectors (``least_found`` at least) is gathered for a
    query, over all trees and with repeats. Leaves next to each other are scored
    together, ``leaves_per_block`` at a time.
    """

    trees: int = 4
    sample: int = 20_000
    leaf: int = 100
    search_share: float = 1.1
    least_found: int = 4_000
    leaves_per_block: int = 32
    seed: int = 11


class Tree:
    """Balanced splits by random directions. Node 0 is the root; leaves are ~number."""

    def __init__(self, points: np.ndarray, leaf: int, rng: np.random.Generator):
        self.normals: list[np.ndarray] = []
        self.offsets: list[float] = []
        self.children: list[list[int]] = []
        self.leaves = 0
        self.root = self._grow(points, leaf, rng)
        self.normals = np.array(self.normals, np.float32).reshape(-1, points.shape[1])
        self.offsets = np.array(self.offsets, np.float32)
        self.children = np.array(self.children, np.int64).reshape(-1, 2)

    def _grow(self, points: np.ndarray, leaf: int, rng: np.random.Generator) -> int:
        if len(points) > leaf:
            one, other = points[rng.choice(len(points), 2, replace=False)]
            normal = one - other
            length = np.linalg.norm(normal)
            normal = normal / length if length > 0 else rng.normal(size=points.shape[1])
            along = points @ normal
            offset = float(np.median(along))
            left = along <= offset
            if left.any() and not left.all():
                node = len(self.normals)
                self.normals.append(normal)
                self.offsets.append(offset)
                self.children.append([0, 0])
                # Leaves get numbers from left to right, so neighbours are close.
                self.children[node][0] = self._grow(points[left], leaf, rng)
                self.children[node][1] = self._grow(points[~left], leaf, rng)
                return node
        self.leaves += 1
        return ~(self.leaves - 1)

    def route(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of every vector."""
        at = np.full(len(vectors), self.root, np.int64)
        while (inside := np.flatnonzero(at >= 0)).size:
            node = at[inside]
            along = np.einsum("ij,ij->i", vectors[inside], self.normals[node])
            at[inside] = self.children[node, (along > self.offsets[node]).astype(int)]
        return ~at


def grow(sample: np.ndarray, policy: ForestPolicy) -> list[Tree]:
    rng = np.random.default_rng(policy.seed)
    return [Tree(sample, policy.leaf, rng) for _ in range(policy.trees)]


def search(forest: list[Tree], sizes: list[np.ndarray], query: np.ndarray, enough: float) -> list[tuple[int, int]]:
    """Leaves (tree, leaf) in the order of one queue over all trees, until they hold enough."""
    margins = [(tree.normals @ query - tree.offsets).tolist() for tree in forest]
    queue = [(-np.inf, at, tree.root) for at, tree in enumerate(forest)]
    found, held = [], 0
    while queue and held < enough:
        worst, at, node = heapq.heappop(queue)
        if node < 0:
            if size := int(sizes[at][~node]):
                found.append((at, ~node))
                held += size
            continue
        margin = margins[at][node]
        left, right = forest[at].children[node].tolist()
        # Priorities are negated margins: the smallest is opened first.
        heapq.heappush(queue, (max(worst, margin), at, left))
        heapq.heappush(queue, (max(worst, -margin), at, right))
    return found


def usable(vector: Column) -> Column:
    """Vectors that take part: not null or empty, no null or non-finite component, not zero."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & fine & F.exists(vector, lambda x: x != 0)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def _lifted(vectors: np.ndarray, most: float) -> np.ndarray:
    """One more component makes all lengths equal, so that nearness by product is nearness by angle."""
    scaled = vectors / most
    rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", scaled, scaled)))
    return np.column_stack([scaled, rest]).astype(np.float32)


def _aimed(vectors: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(vectors, axis=1, keepdims=True)
    return np.column_stack([vectors / lengths, np.zeros(len(vectors))]).astype(np.float32)


def _best(scores: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best scores, ties to the smaller id."""
    there = np.flatnonzero(scores > -np.inf)
    if len(there) > k:
        least = np.partition(scores[there], len(there) - k)[len(there) - k]
        there = there[scores[there] >= least]
    return there[np.lexsort((first[there], -scores[there]))][:k]


def _rerank(k: int):
    """The k best rows of a block for each query that visits some of its leaves."""

    def rerank(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out: list[pd.DataFrame] = []
        if len(rows) and len(queries):
            rows = rows.sort_values(["leaf", "uid"])
            vectors = np.stack([np.frombuffer(x, np.float64) for x in rows["vector"]])
            asked = np.stack([np.frombuffer(x, np.float64) for x in queries["vector"]])
            uids, first, leaf = (rows[name].to_numpy() for name in ("uid", "first", "leaf"))
            names, starts = np.unique(leaf, return_index=True)
            stops = np.append(starts[1:], len(leaf))
            visits = [set(leaves) for leaves in queries["leaves"]]
            own = queries["query"].to_numpy()
            step = max(1, 4_000_000 // len(rows))
            for at in range(0, len(asked), step):
                part = asked[at : at + step]
                scores = np.full((len(part), len(rows)), -np.inf)
                for name, start, stop in zip(names.tolist(), starts, stops):
                    here = [i for i in range(len(part)) if name in visits[at + i]]
                    if here:
                        scores[here, start:stop] = part[here] @ vectors[start:stop].T
                for i, row in enumerate(scores):
                    best = _best(row, first, k)
                    # Row by row, so that a pair's score does not depend on its block.
                    exact = np.einsum("ij,ij->i", vectors[best], np.broadcast_to(part[i], (len(best), part.shape[1])).copy())
                    out.append(
                        pd.DataFrame({"query": own[at + i], "uid": uids[best], "first": first[best], "score": exact})
                    )
        if out:
            return pd.concat(out, ignore_index=True)
        return pd.DataFrame({"query": [], "uid": [], "first": [], "score": []}).astype(
            {"query": "int64", "uid": "int64", "first": "int64", "score": "float64"}
        )

    return rerank


def _top(df: DataFrame, by: str, order: list[Column], k: int) -> DataFrame:
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).where(
        F.col("rank") <= k
    )


def _empty(vectors: DataFrame) -> DataFrame:
    return vectors.sparkSession.createDataFrame(
        [], "query_id bigint, rank int, vec_id bigint, score double"
    )


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    policy: ForestPolicy = ForestPolicy(),
    rows_per_task: int = 20_000,
    queries_per_task: int = 5_000,
) -> DataFrame:
    """The k rows of largest inner product found for every query row.

    ``vectors`` has vec_id and embedding; other columns are read only by
    ``is_query``. Result: query_id, rank (from 1), vec_id, score (in double
    precision, of the vectors as given). Ties go to the smaller vec_id, and a
    query does not find its own id. Unusable vectors and null ids take no part,
    nor do vectors of a length other than the most frequent one. Repeated rows
    count once. With fewer candidates than k all are found; an empty table gives
    an empty result.
    """
    given = vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", is_query.alias("asks")
    )
    lengths = given.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if lengths is None:
        return _empty(vectors)
    given = given.where(F.size("embedding") == lengths["d"])
    copies = Window.partitionBy("embedding").orderBy("vec_id")
    # The rank filter is also applied before the shuffle, so copies do not meet in one task.
    few = (
        given.select("vec_id", "embedding")
        .withColumn("_copy", F.dense_rank().over(copies))
        .where(F.col("_copy") <= k + 1)
        .groupBy("embedding")
        .agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    )
    known = stage(few.withColumn("uid", F.monotonically_increasing_id()).withColumn("first", F.col("ids")[0]))
    squares = F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows, most = known.agg(F.count(F.lit(1)), F.sqrt(F.max(squares))).first()
    asked = stage(
        given.where(F.col("asks"))
        .select(F.col("vec_id").alias("query_id"), "embedding")
        .distinct()
        .join(known.select(F.col("embedding").alias("_e"), F.col("uid").alias("query")), F.col("embedding") == F.col("_e"))
        .select("query_id", "query")
    )
    classes = asked.select("query").distinct()

    share = min(1.0, policy.sample / rows)
    chosen = F.pmod(F.xxhash64("uid", F.lit(policy.seed)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1
    fitted = known.where(chosen).select("embedding").toPandas()["embedding"]
    forest = grow(_lifted(np.stack([np.asarray(x, np.float64) for x in fitted]), most), policy)
    per_block = policy.leaves_per_block
    row_parts = max(1, -(-rows * per_block // (rows_per_task * max(tree.leaves for tree in forest))))
    query_parts = max(1, -(-classes.count() // queries_per_task))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _matrix(batch.column(2))
            lifted, data = _lifted(own, most), [row.tobytes() for row in own]
            for at, tree in enumerate(forest):
                leaf = tree.route(lifted)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        batch.column(1),
                        pa.array(np.full(len(leaf), at, np.int32)),
                        pa.array(leaf),
                        pa.array(data, pa.binary()),
                    ],
                    ["uid", "first", "tree", "leaf", "vector"],
                )

    routed = stage(
        known.select("uid", "first", "embedding").mapInArrow(
            route, "uid bigint, first bigint, tree int, leaf bigint, vector binary"
        )
    )
    # One row per leaf of the forest, whose size the sample bounds.
    held = routed.groupBy("tree", "leaf").count().collect()
    sizes = [np.zeros(tree.leaves, np.int64) for tree in forest]
    for row in held:
        sizes[row["tree"]][row["leaf"]] = row["count"]
    enough = max(policy.search_share * rows, policy.least_found)

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _matrix(batch.column(1))
            out: list[tuple] = []
            for query, vector, aimed in zip(batch.column(0).to_pylist(), own, _aimed(own)):
                blocks: dict[tuple[int, int], list[int]] = {}
                for tree, leaf in search(forest, sizes, aimed, enough):
                    blocks.setdefault((tree, leaf // per_block), []).append(leaf)
                data = vector.tobytes()
                out.extend((query, tree, block, leaves, data) for (tree, block), leaves in blocks.items())
            columns = list(zip(*out)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(columns, kinds)],
                ["query", "tree", "block", "leaves", "vector"],
            )

    visits = (
        known.join(classes, F.col("uid") == F.col("query"), "left_semi")
        .select(F.col("uid").alias("query"), "embedding")
        .mapInArrow(visit, "query bigint, tree int, block bigint, leaves array<bigint>, vector binary")
        .withColumn("q", F.pmod(F.xxhash64("query"), F.lit(query_parts)).cast("int"))
        .withColumn("r", F.explode(F.sequence(F.lit(0), F.lit(row_parts - 1))))
    )
    blocks = (
        routed.withColumn("block", F.floor(F.col("leaf") / per_block).cast("bigint"))
        .withColumn("r", F.pmod(F.xxhash64("uid"), F.lit(row_parts)).cast("int"))
        .withColumn("q", F.explode(F.sequence(F.lit(0), F.lit(query_parts - 1))))
    )
    keys = ["tree", "block", "r", "q"]
    found = (
        blocks.groupBy(*keys)
        .cogroup(visits.groupBy(*keys))
        .applyInPandas(_rerank(k + 1), "query bigint, uid bigint, first bigint, score double")
        .distinct()
    )
    best = _top(found, "query", [F.desc("score"), F.col("first"), F.col("uid")], k + 1)
    named = best.drop("rank", "first").join(known.select("uid", "ids"), "uid")
    expanded = named.select("query", "score", F.explode("ids").alias("vec_id")).distinct()
    per_class = _top(expanded, "query", [F.desc("score"), F.col("vec_id")], k + 1).drop("rank")
    per_query = asked.join(per_class, "query").where(F.col("query_id") != F.col("vec_id"))
    return _top(per_query, "query_id", [F.desc("score"), F.col("vec_id")], k).select(
        "query_id", "rank", "vec_id", "score"
    )

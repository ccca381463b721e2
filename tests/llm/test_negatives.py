import math

import numpy as np
import pytest
from helpers_llm import spark_rows, sql_rows
from pyspark.sql import functions as F

from granero.llm import negatives
from granero.llm.negatives import Ask, TreePolicy
from granero.llm.oracle import ORACLE
from granero.llm.queries import QUERIES

NAME = "op12_split_point_negatives"
SCHEMA = "vec_id bigint, embedding array<float>, label int, score string, rank string, query string, key int, v int"
SMALL = TreePolicy(sample=60, fanout=4, leaf=6, rows_per_task=40, queries_per_task=5)


def brute(rows, is_anchor, ask):
    """All pairs in whole numbers; rows are (id, vector, label) of distinct ids."""
    whole = [(i, [math.floor(ask.scale * float(np.float32(x))) for x in v], label) for i, v, label in rows]
    out = set()
    for a, va, la in whole:
        if not is_anchor(a):
            continue
        scored = sorted((-sum(x * y for x, y in zip(va, v)), i, label) for i, v, label in whole if i != a)
        for down, p, _ in [x for x in scored if x[2] == la][: ask.positives]:
            fits = [
                (n, i) for n, i, label in scored
                if label != la and ask.least_percent * -down <= 100 * -n <= ask.most_percent * -down
            ]
            out |= {(a, p, rank, i, -down, -n) for rank, (n, i) in enumerate(fits[: ask.negatives], 1)}
    return out


def table(spark, rows):
    return spark.createDataFrame([(*row, "clash", "clash", "clash", 1, 2) for row in rows], SCHEMA)


def mined(spark, rows, every=5, ask=Ask(), policy=SMALL):
    return {tuple(row) for row in negatives.hard_negatives(table(spark, rows), F.col("vec_id") % every == 0, ask, policy).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()}


def clusters(rng, n, d=6, centres=8):
    """Vectors around few centres, of very different lengths, and many copies."""
    middle = rng.normal(size=(centres, d)) * 3
    rows = [(i, middle[i % centres] + rng.normal(size=d) * 0.15, int(rng.integers(4))) for i in range(n)]
    rows += [(n + i, rows[i % 3][1], i % 4) for i in range(n // 2)]
    return [(i, [float(np.float32(x)) for x in v], label) for i, v, label in rows]


def test_equals_sql_and_awkward_rows(spark, tmp_path):
    nan, far = float("nan"), float("inf")
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=4)], int(rng.integers(3))) for i in range(120)]
    rows += rows[:7] + [(50, [9.0, 9.0, 9.0, 9.0], 2), (100, [0.0] * 4, 1), (-50, [0.5] * 4, 0), (-14, [0.25] * 4, -1)]
    rows += [(300, None, 1), (350, [1.0, None, 1.0, 1.0], 1), (400, [nan, 1.0, 1.0, 1.0], 1), (450, [far, 1.0, 1.0, 1.0], 0)]
    rows += [(500, [1.0], 1), (550, [], 1), (600, [1.0] * 4, None), (None, [1.0] * 4, 1), (650, [1.0] * 4, 1), (651, [1.0] * 4, 1)]
    table(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    assert spark_rows(QUERIES[NAME](spark, str(tmp_path))) == sql_rows(tmp_path, ORACLE[NAME])


@pytest.mark.parametrize("ask", [Ask(), Ask(positives=2, negatives=4, least_percent=0, most_percent=100, scale=7)])
def test_equals_brute_force_with_blocks_parts_and_copies(spark, ask):
    rows = clusters(np.random.default_rng(8), 200)
    want = brute(rows, lambda i: i % 5 == 0, ask)
    assert len(want) > 300
    assert mined(spark, rows, ask=ask) == want
    whole = TreePolicy(sample=1_000, leaf=1_000)  # one leaf only
    assert mined(spark, rows, ask=ask, policy=whole) == want


def test_large_components_stay_exact(spark):
    rows = [(i, [float(np.float32(x)) for x in np.random.default_rng(i).normal(size=3) * 9_000], i % 2) for i in range(40)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 5 == 0, Ask())
    huge = rows + [(50, [3e38, 1.0, -3e38], 0), (55, [3e38, 2.0, -3e38], 0), (56, [1e38, 0.0, 0.0], 1)]
    assert {row[0] for row in mined(spark, huge)} <= {i for i, _, _ in huge}


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0], 1)], [(0, [1.0], 1), (1, [1.0], 1)], [(0, None, 1)], [(1, [1.0], 1), (2, [0.9], 0)]])
def test_nothing_to_find(spark, rows):
    assert mined(spark, rows) == set()


def grown(points, policy):
    tree = negatives.Tree(negatives.Space(float(np.linalg.norm(points, axis=1).max())), points, policy)
    lifted = tree.space.lift(points)
    leaf = tree.route(lifted)
    tree.low, tree.high = tree.ranges(lifted, leaf)
    return tree, leaf


def test_ranges_are_those_of_the_rows_below():
    points = np.random.default_rng(1).integers(-90, 90, (300, 5))
    tree, leaf = grown(points, TreePolicy(fanout=3, leaf=20))
    lifted = tree.space.lift(points)
    assert len(tree.nodes) > 3 and set(leaf) <= set(range(tree.leaves))
    for node in tree.nodes:
        for child, (start, stop) in enumerate(zip(node.starts, node.starts[1:])):
            below = lifted[(leaf >= start) & (leaf < stop)]
            for point, split in enumerate(node.points):
                far = np.linalg.norm(below - split, axis=1)
                slot = node.slot + point * len(node.children) + child
                if len(far):
                    assert abs(tree.low[slot] - far.min()) < 1e-3 and abs(tree.high[slot] - far.max()) < 1e-3


def test_only_leaves_without_rows_in_a_window_are_left_out():
    rng = np.random.default_rng(6)
    points = (np.repeat(rng.normal(size=(12, 8)) * 400, 50, axis=0) + rng.normal(size=(600, 8)) * 8).astype(np.int64)
    tree, leaf = grown(points, TreePolicy(fanout=6, leaf=30))
    asked = points[::7]
    scores = negatives.products(asked, points).astype(np.int64)
    edges = np.sort(rng.integers(scores.min(), scores.max(), (len(asked), 2, 2)), axis=2)
    least, most = edges[:, :, 0], np.minimum(edges[:, :, 1], edges[:, :, 0] + 20_000)
    anchors = np.column_stack([asked, np.zeros(len(asked))])
    alive = tree.survivors(anchors, tree.space.at_score(anchors, most), tree.space.at_score(anchors, least))
    held = ((scores[:, None, :] >= least[:, :, None]) & (scores[:, None, :] <= most[:, :, None])).any(axis=1)
    for anchor in range(len(asked)):
        assert alive[anchor][leaf[held[anchor]]].all()
    assert alive.mean() < 0.6
    none = tree.survivors(anchors, np.full((len(asked), 1), np.inf), np.full((len(asked), 1), -np.inf))
    assert not none.any()


def test_products_choose_an_exact_type():
    for size in (10, 1 << 13, 1 << 27, (1 << 30) - 1):
        one = np.random.default_rng(size).integers(-size, size, (9, 5))
        found = negatives.products(one, one[:4])
        want = [[sum(int(x) * int(y) for x, y in zip(a, b)) for b in one[:4]] for a in one]
        assert found.astype(np.int64).tolist() == want


def test_blocks_hold_all_leaves_once():
    blocks = negatives.blocks_of(np.array([5, 5, 30, 0, 2, 9]), 10)
    assert blocks == [(0, 2, 1), (2, 3, 3), (3, 5, 1), (5, 6, 1)]
    assert negatives.blocks_of(np.array([0]), 10) == [(0, 1, 1)]


def test_windows_are_raised_to_what_a_sample_reaches():
    scores = np.array([[5, 9, 7, 3, 8]], np.float32)
    other = np.array([[False, False, True, False, False]])
    least, most = np.array([[0, 0, 1]]), np.array([[100, 8, 0]])
    assert negatives.raised(scores, other, least, most, 2, True).tolist() == [[8, 5, 1]]
    assert negatives.raised(scores, other, least, most, 2, False).tolist() == [[0, 0, 1]]

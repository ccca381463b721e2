import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from granero.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, asks, k):
    good = [(i, np.array(v, np.float64)) for i, v in rows]
    out = {}
    for q, x in good:
        if asks(q):
            scored = sorted((-float(np.float64(x @ y)), i) for i, y in good if i != q)
            out[q] = [i for _, i in scored[:k]]
    return out


def test_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    policy = ann.ForestPolicy(leaf=20, least_found=0)
    found = ann.nearest(table, F.col("vec_id") % 20 == 0, policy=policy).collect()
    want = brute(rows, lambda q: q % 20 == 0, 20)
    hits = sum(r.vec_id in want[r.query_id] for r in found)
    assert len(found) == 20 * len(want)
    assert hits >= 0.9 * len(found)


def test_copies_ties_and_unusable_vectors(spark):
    nan = float("nan")
    rows = [(i, [1.0, 0.0]) for i in range(60)] + [(100, [0.5, 0.5]), (120, [0.5, 0.5]), (101, [-3.0, 0.1])]
    bad = [(200, None), (201, [0.0, 0.0]), (202, [nan, 1.0]), (203, [math.inf, 1.0]), (204, [1.0, None]), (205, []), (None, [1.0, 1.0]), (206, [1.0, 2.0, 3.0])]
    table = spark.createDataFrame([(*r, 0) for r in rows + bad + rows[:3]], SCHEMA)
    found = ann.nearest(table, F.col("vec_id") % 20 == 0, k=5).orderBy("query_id", "rank").collect()
    by = {}
    for r in found:
        by.setdefault(r.query_id, []).append(r.vec_id)
    assert by[0] == [1, 2, 3, 4, 5] and by[20] == [0, 1, 2, 3, 4] and by[100] == [0, 1, 2, 3, 4]
    assert set(by) == {0, 20, 40, 100, 120}


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0])], [(0, [1.0, 2.0]), (1, [2.0, 1.0])]])
def test_few_rows(spark, rows):
    table = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    found = ann.nearest(table, F.col("vec_id") % 20 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in found] == ([(0, 1, 1)] if len(rows) == 2 else [])

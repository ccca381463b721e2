import pytest
from pyspark.sql import functions as F

from granero.operators.upsert import one_per_key, upsert
from granero.sinks.targets import CORREDOR
from tests.helpers import bag

KEYS, UPDATES = list(CORREDOR.keys), list(CORREDOR.updates)


def brokers(spark, rows):
    return spark.createDataFrame(rows, CORREDOR.schema)


def test_update_and_insert(spark):
    target = brokers(spark, [(1, 10, 5, "OLD"), (3, 30, 1, "KEPT")])
    batch = brokers(spark, [(1, 10, 7, "NEW"), (2, 20, 0, "X")])
    after = upsert(target, batch, KEYS, UPDATES)
    expected = {(1, 10, 7, "NEW"), (2, 20, 0, "X"), (3, 30, 1, "KEPT")}
    assert {tuple(row) for row in after.collect()} == expected
    assert bag(upsert(after, batch, KEYS, UPDATES)) == bag(after)


def test_update_to_null_and_columns_that_stay(spark):
    schema = "k int, a int, b int"
    target = spark.createDataFrame([(1, 10, 100), (None, 20, 200)], schema)
    batch = spark.createDataFrame([(1, None, 999), (None, 21, 999), (2, 30, 300)], schema)
    after = upsert(target, batch, ["k"], ["a"])
    expected = {(1, None, 100), (None, 21, 200), (2, 30, 300)}
    assert {tuple(row) for row in after.collect()} == expected


def test_one_per_key_takes_the_greatest(spark):
    batch = brokers(spark, [(1, 1, 3, "A"), (1, 1, 5, "A"), (1, 1, 5, "B"), (2, 1, 0, None)])
    got = one_per_key(batch, KEYS, UPDATES)
    assert {tuple(row) for row in got.collect()} == {(1, 1, 5, "B"), (2, 1, 0, None)}


def test_one_per_key_wants_a_full_order(spark):
    with pytest.raises(ValueError):
        one_per_key(brokers(spark, []), KEYS, ["CorredorDV"])


def test_hot_key_is_combined_before_the_shuffle(spark):
    from tests.helpers import plan

    batch = spark.range(1000).select(
        F.lit(1).alias("AgenteID"),
        F.lit(2).alias("CorredorID"),
        F.col("id").cast("int").alias("CorredorDV"),
        F.lit("X").alias("NombreCorredor"),
    )
    assert "partial_max" in plan(one_per_key(batch, KEYS, UPDATES))

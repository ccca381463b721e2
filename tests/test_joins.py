import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from granero.functions.keys import text_key, with_single_key
from granero.operators import skew
from granero.operators.pairs import group_sizes, hot_cells, matched, pair_join, pairs_with_values
from granero.plans.coverage import tariff_pairs
from granero.plans.product import PRODUCT_NAMES, plan_products, product_bridge
from granero.operators.project import rename
from granero.plans.product import producto_load
from tests.helpers import bag, plan

ON = [("a", "c"), ("b", "d")]


def sides(spark, left, right):
    return (
        spark.createDataFrame(left, "a string, b string, x int"),
        spark.createDataFrame(right, "c string, d string, y int"),
    )


def joined(spark, left, right, **options):
    pairs = pair_join(*sides(spark, left, right), ON, **options)
    return bag(pairs.select("l.x", "r.y"))


@pytest.mark.parametrize(
    "parts, key",
    [
        ((None, "x"), "null-x"),
        ((None, None), "null-null"),
        (("a-b", "c"), "a-b-c"),
        (("a", "b-c"), "a-b-c"),
        (("", ""), "-"),
    ],
)
def test_text_key(spark, parts, key):
    df = spark.createDataFrame([parts], "a string, b string")
    assert df.select(text_key(F.col("a"), F.col("b"))).first()[0] == key


def test_single_key_drops_rows_without_it(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    assert [tuple(row) for row in with_single_key(df, "k").collect()] == [(1, "a", "1")]


@pytest.mark.parametrize("mode", ["text", "columns"])
def test_missing_joins_missing_as_a_bag(spark, mode):
    left = [(None, "1", 1), (None, "1", 2), ("p", None, 3), ("p", "q", 4), ("z", "z", 5)]
    right = [(None, "1", 10), (None, "1", 20), ("p", None, 30), ("p", "q", 40), ("y", "y", 50)]
    assert set(joined(spark, left, right, key_mode=mode)) == {
        (1, 10),
        (1, 20),
        (2, 10),
        (2, 20),
        (3, 30),
        (4, 40),
    }


def test_collisions_only_in_text_mode(spark):
    left = [(None, "1", 1), ("a-b", "c", 2)]
    right = [("null", "1", 10), ("a", "b-c", 20)]
    assert set(joined(spark, left, right)) == {(1, 10), (2, 20)}
    assert not joined(spark, left, right, key_mode="columns")


def test_modes_agree_without_collisions(spark, sf_dir):
    from checks.adapters import source_tables

    tables = source_tables(spark, sf_dir)
    text = producto_load(tables, key_mode="text")
    assert bag(text) == bag(producto_load(tables, key_mode="columns"))


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        joined(spark, [], [], key_mode="fuzzy")


def test_group_sizes(spark):
    left = [("a", "1", 0), ("a", "1", 0), (None, "1", 0), ("l", "1", 0)]
    right = [("a", "1", 0), (None, "1", 0), (None, "1", 0), ("r", "1", 0)]
    assert set(bag(group_sizes(*sides(spark, left, right), ON))) == {
        ("a-1", 2, 2, 1),
        ("null-1", 1, 2, 2),
        ("l-1", 1, 0, 0),
        ("r-1", 0, 0, 1),
    }


@pytest.mark.parametrize("mode", ["text", "columns"])
def test_matched_keeps_left_rows_once(spark, mode):
    left = [("a", None, 1), ("a", None, 1), ("b", "1", 2)]
    right = [("a", None, 0), ("a", None, 0)]
    got = matched(*sides(spark, left, right), ON, mode)
    assert got.columns == ["a", "b", "x"]
    assert [row.x for row in got.collect()] == [1, 1]


def product_tables(spark, bridge, products=None, plans=None):
    return {
        "te_producto_cial": spark.createDataFrame(
            products or [("1", "10", "Auto"), (None, "20", None)],
            "cod_ramo string, cod_producto string, txt_desc string",
        ),
        "te_producto_tec_cial": spark.createDataFrame(
            bridge,
            "cod_ramo_com string, cod_producto_cial string, cod_ramo string,"
            " cod_producto_tec string",
        ),
        "tiso_producto": spark.createDataFrame(
            plans or [("7", "5", "Plan A", "3"), ("7", "6", None, None)],
            "cod_ramo string, cod_producto string, txt_desc string, cod_suc string",
        ),
    }


def test_product_rows_by_hand(spark):
    tables = product_tables(spark, [("1", "10", "7", "5.0"), (None, "20", "7", "6.9")])
    rows = {tuple(row) for row in producto_load(tables).collect()}
    assert rows == {
        (7, 5, "Plan A", 0, 0, 1, 10, "Auto", 3, 0, 0, None),
        (7, 6, "Sin Plan", 0, 0, 0, 20, None, 0, 0, 0, None),
    }


def test_plan_code_with_a_fraction_meets_none(spark):
    tables = product_tables(
        spark, [("1", "10", "7", "5.0")], plans=[("7", "5.0", "Plan A", "3")]
    )
    assert producto_load(tables).count() == 0


@pytest.mark.parametrize("code", ["K", None])
def test_bad_technical_code_fails_only_if_it_joins(spark, code):
    lonely = product_tables(spark, [("1", "10", "7", "5"), ("9", "99", "7", code)])
    assert producto_load(lonely).count() == 1
    joining = product_tables(spark, [("1", "10", "7", "5"), ("1", "10", "7", code)])
    with pytest.raises(PySparkException):
        producto_load(joining).collect()


def test_bad_product_code_fails_only_if_it_joins(spark):
    products = [("1", "10", "Auto"), ("1", "K", "Junk")]
    lonely = product_tables(spark, [("1", "10", "7", "5")], products)
    assert len(producto_load(lonely).collect()) == 1
    joining = product_tables(spark, [("1", "K", "7", "5")], products)
    with pytest.raises(PySparkException):
        producto_load(joining).collect()


def test_early_parse_gives_the_rows_of_the_late_one(spark, sf_dir):
    from checks.adapters import source_tables
    from granero.sinks.targets import PRODUCTO

    tables = source_tables(spark, sf_dir)
    bridged = product_bridge(
        rename(tables["te_producto_cial"], PRODUCT_NAMES), tables["te_producto_tec_cial"]
    )
    late = PRODUCTO.rows(plan_products(tables["tiso_producto"], bridged))
    assert bag(late) == bag(producto_load(tables))


def test_joins_by_columns_compare_a_hash_of_all_parts_first(spark):
    left, right = sides(spark, [("1", "2", 1), (None, "2", 2), ("a-b", "c", 3)], [("1", "2", 1), (None, "2", 2), ("a", "b-c", 3)])
    pairs = pair_join(left, right, ON, "columns")
    assert "Join [_cell#" in plan(pairs)
    assert bag(pairs.select("l.x", "r.y")) == {(1, 1): 1, (2, 2): 1}
    numbers = left.select(F.lit(7).alias("a"), F.lit(None).cast("int").alias("b"), "x")
    texts = right.select(F.lit("7").alias("c"), F.lit(None).cast("string").alias("d"), "y")
    assert pair_join(numbers, texts, ON, "columns").count() == 9


@pytest.mark.parametrize("most", [1, 2, 1024])
@pytest.mark.parametrize("policy", [None, skew.SkewPolicy(pairs_per_cell=2, sample=1.0)])
def test_pairs_with_values_are_the_pairs(spark, most, policy):
    left = [("1", "2", 1), ("1", "2", 1), (None, "2", 2), ("null", "2", 3), ("4", "4", 4)]
    right = [("1", "2", 1)] * 5 + [("1", "2", 6), (None, "2", 2), (None, "2", 2), ("5", "5", 5)]
    sides_ = sides(spark, left, right)
    cells = hot_cells(*sides_, ON, policy)
    assert bool(cells) == (policy is not None)
    pairs = pairs_with_values(*sides_, ON, "y", cells, most).select("x", "y")
    assert bag(pairs) == bag(pair_join(*sides_, ON).select("l.x", "r.y"))
    assert pairs_with_values(*(side.limit(0) for side in sides_), ON, "y").count() == 0


def test_tariff_pairs_are_made_after_the_join_by_all_tasks(spark):
    plans = spark.range(3).selectExpr("'1' AS cod_tarifa", "'1' AS cod_ramo", "'A' AS cod_producto")
    texts = spark.range(2000).selectExpr("'1' AS cod_tarifa", "IF(id % 3 = 0, NULL, 'x') AS txt_desc")
    pairs = tariff_pairs({"ttarifa_producto": plans, "ttarifa": texts})
    assert "explode(_values" in plan(pairs) and "REPARTITION_BY_NUM" in plan(pairs)
    assert bag(pairs.select("Cobertura")) == {("",): 3 * 667, ("x",): 3 * 1333}

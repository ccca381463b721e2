import pytest
from pyspark.sql import functions as F

from granero.operators import skew
from granero.operators.pairs import hot_cells, pair_join
from granero.plans.broker import producto_corredor_load
from granero.plans.coverage import coverages, producto_cobertura_load
from granero.plans.product import producto_load
from granero.sources.jdbc import read_back
from granero.sources.staging import stage
from tests.helpers import bag, plan

ON = [("k", "k")]
EAGER = skew.SkewPolicy(pairs_per_cell=2500, sample=1.0)


def hot_sides(spark, copies=3000):
    """A third of both sides under one key, all copies of one row on the left."""
    left = spark.range(3 * copies).select(
        F.when(F.col("id") >= copies, F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") < copies, F.lit(-1)).otherwise(F.col("id")).alias("x"),
    )
    right = spark.range(300).select(
        F.when(F.col("id") >= 100, (F.col("id") * 20).cast("string")).alias("k"),
        F.col("id").alias("y"),
    )
    return stage(left), stage(right)


def measured(left, right, policy=EAGER):
    return hot_cells(left, right, ON, policy)


def test_hot_keys_are_found(spark):
    # 300,000 pairs in 120 cells; 60 lines of 50 rows, 2 columns of 50 rows.
    assert measured(*hot_sides(spark)) == [("null", 60, 2)]


def test_sampled_counts_are_scaled(spark):
    left, right = hot_sides(spark, copies=20_000)
    policy = skew.SkewPolicy(pairs_per_cell=100_000, sample=0.1)
    [(key, lines, columns)] = measured(left, right, policy)
    assert key == "null"
    assert 10 < lines * columns < 32


def test_keys_hot_on_one_side_do_not_crowd_out_those_that_pair(spark):
    left = spark.range(3000).select((F.col("id") % 30).cast("string").alias("k"))
    pairing = spark.range(60).select(F.lit("both").alias("k"))
    policy = skew.SkewPolicy(pairs_per_cell=100, sample=1.0, top=1)
    assert measured(stage(left.union(pairing)), stage(pairing), policy) == [("both", 6, 6)]


def many_hot(spark, keys=1_500, rows=60):
    """Hot keys on both sides, more than reach the driver, one rarer key, and repeated rows."""
    side = spark.range(keys * rows).select((F.col("id") % keys).cast("string").alias("k"), F.floor(F.col("id") / keys / 2).alias("x"))
    return stage(side.union(spark.createDataFrame([("once", 1)], "k string, x bigint"))), stage(
        side.withColumnRenamed("x", "y").union(spark.createDataFrame([("once", 1)], "k string, y bigint"))
    )


def test_any_number_of_hot_keys_is_split(spark):
    left, right = many_hot(spark)
    cells = measured(left, right, skew.SkewPolicy(pairs_per_cell=1_000, sample=1.0, top=1_000))
    assert len(cells) == 1_000 and cells.table.count() == 1_500
    grids = {row["_hot"]: (row["_left"], row["_right"]) for row in cells.table.collect()}
    assert all(grids[key] == (lines, columns) for key, lines, columns in cells)
    dealt = skew.deal(left.withColumn("_key", F.col("k")), "_key", cells, "left")
    spread = dealt.groupBy("k").agg(F.count_distinct("_row", "_column").alias("n"))
    assert spread.where("n > 1").count() == 1_500 and spread.where("n = 1").count() == 1
    split = pair_join(left, right, ON, "text", cells).groupBy("l.k", "l.x", "r.y").count()
    whole = pair_join(left, right, ON).groupBy("l.k", "l.x", "r.y").count()
    assert split.exceptAll(whole).isEmpty() and whole.exceptAll(split).isEmpty()


def test_whole_tables_are_counted_once(spark, monkeypatch):
    left, right = many_hot(spark)
    read = []

    def watched(df):
        read.append(set(df.inputFiles()))
        return stage(df)

    monkeypatch.setattr(skew, "stage", watched)
    cells = measured(left, right, skew.SkewPolicy(pairs_per_cell=1_000, sample=1.0, top=1_000))
    assert cells.table.count() == 1_500
    assert read[-1].isdisjoint({*left.inputFiles(), *right.inputFiles()})


@pytest.mark.parametrize("mode", ["text", "columns"])
def test_split_joins_compare_the_cell_first(spark, mode):
    left, right = hot_sides(spark)
    joined = pair_join(left, right, ON, mode, measured(left, right))
    assert "Join [_cell#" in plan(joined)


def test_one_sided_keys_crowd_out_none_in_a_sample(spark):
    one_sided = spark.range(200_000).select((F.col("id") % 40).cast("string").alias("k"), "id")
    both = spark.range(3_000).select(F.lit("both").alias("k"), "id")
    policy = skew.SkewPolicy(pairs_per_cell=20_000, sample=0.1, top=10)
    cells = measured(stage(one_sided.union(both)), stage(both), policy)
    assert "both" in {row["_hot"] for row in cells.table.collect()} if cells.table else "both" in dict((key, 1) for key, *_ in cells)


@pytest.mark.parametrize("left, right", [(1, 1), (10, 10), (90_000, 1), (1, 90_000), (3_000, 100), (777, 1_313), (5_000, 5_000)])
def test_grids_as_columns_are_the_same(spark, left, right):
    for policy in (skew.SkewPolicy(1_000, 1.0), skew.SkewPolicy(2_500, 0.1), skew.SkewPolicy(7, 0.5)):
        row = spark.createDataFrame([("k", left, right)], "key string, left bigint, right bigint").select(*skew._grid_columns(policy)).first()
        assert (row["_left"], row["_right"]) == skew.grid(left / policy.sample, right / policy.sample, policy)


def test_joins_do_not_share_their_places(spark):
    one = spark.range(500).select(F.lit("a").alias("k"))
    two = spark.range(50).select(F.lit("b").alias("k"))
    policy = skew.SkewPolicy(pairs_per_cell=100, sample=1.0, top=1)
    key = F.col("k")
    found = skew.join_cells(
        [(one, {("x", "left"): key, ("x", "right"): key}), (two, {("y", "left"): key, ("y", "right"): key})],
        policy,
    )
    assert [cells[0][0] for cells in found.values()] == ["a", "b"]


def test_cells_hold_the_wanted_number_of_pairs():
    policy = skew.SkewPolicy(pairs_per_cell=1000)
    for left, right in [(10, 10), (1e9, 1), (1, 1e9), (1e6, 1e6), (5e4, 300)]:
        lines, columns = skew.grid(left, right, policy)
        assert left * right / (lines * columns) <= 1.6 * policy.pairs_per_cell
        assert lines <= left and columns <= right


@pytest.mark.parametrize("mode", ["text", "columns"])
def test_split_keeps_every_pair_once(spark, mode):
    left, right = hot_sides(spark)
    cells = measured(left, right)
    whole = pair_join(left, right, ON, mode).select("l.x", "r.y")
    split = pair_join(left, right, ON, mode, cells).select("l.x", "r.y")
    assert whole.count() > 300_000
    assert bag(split) == bag(whole)


def test_split_spreads_a_hot_key_over_tasks(spark):
    left, right = hot_sides(spark)
    cells = measured(left, right)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        def largest_task(grid):
            pairs = pair_join(left, right, ON, "text", grid).select("l.x", "r.y")
            sizes = pairs.groupBy(F.spark_partition_id().alias("p")).count()
            return max(row["count"] for row in sizes.collect())

        total = pair_join(left, right, ON).count()
        assert largest_task([]) > 0.95 * total
        assert largest_task(cells) < 0.3 * total
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_carried_positions_are_used(spark):
    left, right = hot_sides(spark)
    cells = measured(left, right)
    numbered = skew.with_position(left).repartition(5)
    split = pair_join(numbered, right, ON, "text", cells).select("l.x", "r.y")
    assert bag(split) == bag(pair_join(left, right, ON).select("l.x", "r.y"))


def test_flows_do_not_depend_on_splits(spark, sf_dir):
    from checks.adapters import source_tables
    from granero.plans.broker import corredor_load

    tables = source_tables(spark, sf_dir)
    tiny = skew.SkewPolicy(pairs_per_cell=25, sample=1.0, top=20)
    plain = producto_load(tables, policy=None)
    assert bag(producto_load(tables, policy=tiny)) == bag(plain)

    ids = F.xxhash64(*plain.columns).cast("int").alias("ProductoId")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        producto = stage(read_back(plain.select("*", ids)))
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    covered = stage(coverages(tables))
    assert bag(producto_cobertura_load(producto, covered, policy=tiny)) == bag(
        producto_cobertura_load(producto, covered, policy=None)
    )
    assert bag(producto_corredor_load(tables, producto, policy=tiny)) == bag(
        producto_corredor_load(tables, producto, policy=None)
    )
    assert bag(corredor_load(tables, policy=tiny)) == bag(corredor_load(tables, policy=None))


def test_split_queries_split(spark, sf_dir):
    from checks.queries import QUERIES

    for name in [name for name in QUERIES if "_split" in name]:
        assert "_row" in plan(QUERIES[name](spark, sf_dir)), name

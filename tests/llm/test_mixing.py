from collections import defaultdict

from helpers_llm import awkward, empty

from granero.llm import mixing


def test_sources_come_near_their_targets_and_reruns_agree(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = mixing.mix(docs).collect()
    assert sorted(rows) == sorted(mixing.mix(docs.repartition(5)).collect())
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for row in rows:
        taken[row.source] += row.taken
        target[row.source] = row.target
        largest[row.source] = max(largest[row.source], row.size)
        assert row.taken <= 3 * row.size
        assert row.target <= 3 * row.source_size + 1e-6
    assert all(abs(taken[s] - target[s]) <= largest[s] / 2 + 1 for s in target)
    assert abs(sum(target.values()) - sum(row.size for row in rows)) < 1e-3


def test_buckets_do_not_change_the_mix(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "repeat('w ', cast(1 + id % 7 AS int)) AS text", "cast(id % 3 AS string) AS source")
    assert sorted(mixing.mix(docs, rows_per_bucket=1).collect()) == sorted(mixing.mix(docs, rows_per_bucket=10**6).collect())


def test_heavier_documents_come_first(spark):
    from pyspark.sql import functions as F

    docs = spark.range(4000).selectExpr("id AS doc_id", "'w' AS text", "if(id % 2 = 0, 'a', 'b') AS source")
    weight = F.when(F.col("doc_id") % 4 == 1, F.lit(4.0)).otherwise(F.lit(1.0))
    rows = mixing.mix(docs, quality=weight, weights=(3, 1)).where("source = 'b'").collect()
    heavy = sum(r.taken for r in rows if r.doc_id % 4 == 1)
    assert heavy > 0.7 * sum(r.taken for r in rows)


def test_awkward_rows(spark):
    assert mixing.mix(empty(spark)).collect() == []
    docs = awkward(spark)
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == mixing.mix(docs).selectExpr("sum(copies)").first()[0]

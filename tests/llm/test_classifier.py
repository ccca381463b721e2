from helpers_llm import awkward, empty

from granero.llm import rule_ensemble as rules


def test_held_out_accuracy_and_rules(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{name}.parquet") for name in ("documents", "labels"))
    model = rules.fit_rules(docs, labels)
    assert 0 < len(model.weights) < 60 and len(model.describe()) == len(model.weights)
    found = rules.classify(docs, model)
    assert found.count() == docs.count()
    judged = found.join(labels, "doc_id").where("held_out")
    assert judged.selectExpr("avg(cast(predicted = quality AS double))").first()[0] > 0.95
    table = rules.with_statistics(docs.select("doc_id", "text")).withColumn("score", model.score()).limit(50).collect()
    for row in table:
        total = model.intercept
        for rule, weight in model.weights.items():
            if all(row[n] <= t if low else row[n] > t for n, low, t in rule):
                total += weight
        assert abs(1 / (1 + 2.718281828459045**-total) - row.score) < 1e-9
    kept = rules.accepted(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == found.where("predicted = 1").count()
    awkward_docs = awkward(spark)
    assert rules.classify(awkward_docs, model).where("score between 0 and 1").count() == awkward_docs.count()


def test_no_labels(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    model = rules.fit_rules(awkward(spark), labels)
    assert model.weights == {}
    assert {row.score for row in rules.classify(awkward(spark), model).collect()} == {0.5}
    assert rules.classify(empty(spark), model).collect() == []
    one_kind = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (4, None, 0)], labels.schema)
    assert rules.fit_rules(awkward(spark), one_kind).weights == {}


def test_simplest_rule():
    rule = frozenset([("a", True, 2.0), ("a", True, 1.0), ("a", False, 0.0), ("a", False, 0.5)])
    assert rules.simplest(rule) == frozenset([("a", True, 1.0), ("a", False, 0.5)])

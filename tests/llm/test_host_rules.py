from helpers_llm import DOCS, awkward, empty, save, spark_rows, sql_rows

from granero.llm import host_rules
from granero.llm.oracle import ORACLE
from granero.llm.queries import QUERIES

NAME = "op2_host_quality_rules"
CLEAN = " ".join(f"word{i}" for i in range(60))
SIGNS = " ".join(f"wo#${i}#" for i in range(60))


def corpus(spark):
    """A bad host, sixty good ones, and a small one whose only documents are both bad."""
    rows, at = [], 0
    for host, size, bad in [("bad", 100, 80), ("small", 2, 2), *((f"good{i}", 10, i % 2) for i in range(60)), (None, 10, 9)]:
        for i in range(size):
            rows.append((at, f"{SIGNS if i < bad else CLEAN} {at}", "en", host, 1, "clash", 1, "clash", "clash"))
            at += 1
    return spark.createDataFrame(rows, DOCS)


def test_a_bad_host_goes_and_a_small_one_is_spared(spark, tmp_path):
    docs = corpus(spark)
    verdicts = host_rules.host_quality(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    rejected = {row.source for row in verdicts if row.host_rejected}
    assert rejected == {"bad", None}
    assert all(row.kept != row.host_rejected and not row.base_failed for row in verdicts)
    # Without the prior the small host's rate of 1 would be above the limit, too.
    priors = host_rules.beta_priors(
        spark.createDataFrame([("bad", 100, 80), ("small", 2, 2), *((f"good{i}", 10, i % 2) for i in range(60)), (None, 10, 9)], "h string, n bigint, signs bigint"),
        ["signs"],
    )
    a, b = priors["signs"]
    assert (2 + a) / (2 + a + b) < 0.5 < (80 + a) / (100 + a + b)
    folder = save(spark, docs, tmp_path)
    found = spark_rows(QUERIES[NAME](spark, folder))
    assert found == sql_rows(folder, ORACLE[NAME])
    names, rows = found
    assert sum(n for row, n in rows.items() if row[names.index("host_rejected")]) == 110


def test_priors_by_moments(spark):
    def prior(rows):
        return host_rules.beta_priors(spark.createDataFrame(rows, "h string, n bigint, r bigint"), ["r"])["r"]

    # Hosts that differ by no more than chance give the strongest prior.
    a, b = prior([(f"h{i}", 100, 10) for i in range(20)])
    assert abs(a / (a + b) - 0.1) < 1e-9 and abs(a + b - 2_000) < 1e-6
    # The moments of beta(2, 6) are found again from very large hosts.
    rates = [0.0333, 0.0767, 0.1101, 0.1414, 0.1725, 0.2047, 0.2389, 0.2768, 0.3205, 0.3751, 0.4540, 0.5]
    mean = sum(rates) / len(rates)
    spread = sum((r - mean) ** 2 for r in rates) / len(rates)
    a, b = prior([(f"h{i}", 10**9, int(r * 10**9)) for i, r in enumerate(rates)])
    assert abs(a / (a + b) - mean) < 1e-6 and abs(mean * (1 - mean) / (a + b + 1) - spread) < 1e-6
    assert prior([("only", 10, 10)])[0] > 0
    assert host_rules.beta_priors(spark.createDataFrame([], "h string, n bigint, r bigint"), ["r"])["r"]


def test_awkward_rows(spark, tmp_path):
    folder = save(spark, awkward(spark), tmp_path)
    assert spark_rows(QUERIES[NAME](spark, folder)) == sql_rows(folder, ORACLE[NAME])
    assert host_rules.host_quality(empty(spark)).collect() == []
    by_id = {row.doc_id: row for row in host_rules.host_quality(awkward(spark)).collect()}
    assert by_id[4].n_words == by_id[5].n_words == by_id[6].n_words == 0 and by_id[4].base_failed


def test_other_rules_and_hosts(spark):
    docs = spark.createDataFrame([(i, "text " * (60 + i), "x" if i < 8 else "y") for i in range(10)], "doc_id bigint, text string, site string")
    from pyspark.sql import functions as F

    verdicts = host_rules.host_quality(docs, "site", host_rules.HostPolicy(0.0), own={}, shared={"long": F.col("n_words") > 65})
    assert all(row.host_rejected and not row.base_failed for row in verdicts.collect())

import pytest
from helpers_llm import awkward, empty, save, spark_rows, sql_rows

from granero.llm.oracle import ORACLE
from granero.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    assert spark_rows(QUERIES[name](spark, sf_dir)) == sql_rows(sf_dir, ORACLE[name])


@pytest.mark.parametrize("name", ["op2_host_quality_rules", "op3_weighted_source_mix", "op4_license_scan"])
def test_query_equals_sql_on_awkward_rows(spark, tmp_path, name):
    folder = save(spark, awkward(spark), tmp_path)
    assert spark_rows(QUERIES[name](spark, folder)) == sql_rows(folder, ORACLE[name])


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES) if n.split("_")[0] in ("op1", "op2", "op3", "op4", "op7", "op8", "op9")])
def test_empty_table(spark, tmp_path, name):
    folder = save(spark, empty(spark), tmp_path)
    assert QUERIES[name](spark, folder).collect() == []

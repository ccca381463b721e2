import pytest

import __spark_entry__
from checks.compare import difference
from checks.oracle import ORACLE
from checks.queries import QUERIES


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    assert difference(spark, sf_dir, name) is None


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() == 6000

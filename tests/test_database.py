"""The JDBC edge without a database: statements, options, order of steps."""

import pytest
from pyspark.sql import Row

from granero.sinks import database
from granero.sinks.database import append_jdbc, insert_statement, upsert_jdbc, upsert_statement
from granero.sinks.targets import COBERTURA, CORREDOR
from granero.sources.jdbc import jdbc_scan


def test_insert_statement():
    assert insert_statement(COBERTURA, "s") == (
        "INSERT INTO Cobertura (GrupoCoberturaId, CoberturaId, Cobertura)"
        " SELECT GrupoCoberturaId, CoberturaId, Cobertura FROM s"
    )


def test_upsert_statements():
    assert upsert_statement(CORREDOR, "s").endswith(
        "FROM s ON DUPLICATE KEY UPDATE CorredorDV = VALUES(CorredorDV),"
        " NombreCorredor = VALUES(NombreCorredor)"
    )
    assert upsert_statement(CORREDOR, "s", "merge") == (
        "MERGE INTO Corredor t USING s s"
        " ON t.AgenteID = s.AgenteID AND t.CorredorID = s.CorredorID"
        " WHEN MATCHED THEN UPDATE SET CorredorDV = s.CorredorDV,"
        " NombreCorredor = s.NombreCorredor"
        " WHEN NOT MATCHED THEN INSERT (AgenteID, CorredorID, CorredorDV, NombreCorredor)"
        " VALUES (s.AgenteID, s.CorredorID, s.CorredorDV, s.NombreCorredor)"
    )
    with pytest.raises(ValueError):
        upsert_statement(CORREDOR, "s", "other")


@pytest.fixture
def steps(monkeypatch):
    seen = []
    monkeypatch.setattr(
        database, "_stage", lambda rows, url, staging, *rest: seen.append((staging, rows.count()))
    )
    return seen


def test_rows_are_staged_before_the_statement_runs(spark, steps):
    rows = spark.createDataFrame([(None, 1, "x"), (None, 1, "x")], COBERTURA.schema)
    append_jdbc(COBERTURA, rows, "jdbc:none", execute=steps.append)
    assert steps == [("Cobertura_staging", 2), insert_statement(COBERTURA, "Cobertura_staging")]


def test_upsert_stages_one_row_per_key(spark, steps):
    rows = spark.createDataFrame([(1, 1, 1, "A"), (1, 1, 2, "B")], CORREDOR.schema)
    upsert_jdbc(CORREDOR, rows, "jdbc:none", execute=steps.append, staging="s")
    assert steps == [("s", 1), upsert_statement(CORREDOR, "s")]


class Reader:
    """Stands in for a session and its reader; keeps the options of each load."""

    def __init__(self, bounds):
        self.bounds, self.loads = bounds, []

    @property
    def read(self):
        self.current = {}
        return self

    def format(self, name):
        self.current["format"] = name
        return self

    def option(self, name, value):
        return self.options(**{name: value})

    def options(self, **options):
        self.current.update(options)
        return self

    def load(self):
        self.loads.append(self.current)
        return self

    def first(self):
        return self.bounds


def test_scan_is_cut_between_the_least_and_greatest_id():
    reader = Reader(Row(lo=1, hi=100))
    jdbc_scan(reader, "jdbc:none", "Producto", "ProductoId", 4, {"user": "u"})
    bounds, rows = reader.loads
    assert bounds["query"] == (
        "SELECT MIN(ProductoId) AS lo, MAX(ProductoId) AS hi FROM Producto"
    )
    assert rows == {
        "format": "jdbc",
        "url": "jdbc:none",
        "user": "u",
        "dbtable": "Producto",
        "partitionColumn": "ProductoId",
        "lowerBound": "1",
        "upperBound": "101",
        "numPartitions": "4",
    }


def test_scan_of_an_empty_table_is_not_cut():
    reader = Reader(Row(lo=None, hi=None))
    jdbc_scan(reader, "jdbc:none", "Producto", "ProductoId", 4)
    assert "partitionColumn" not in reader.loads[1]

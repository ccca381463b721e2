import pytest
from pyspark.sql import functions as F

from granero.plans.load import load_mart
from granero.sinks.mart import ParquetMart, StaleTable
from granero.sinks.targets import (
    COBERTURA,
    CORREDOR,
    PRODUCTO,
    PRODUCTO_COBERTURA,
    PRODUCTO_CORREDOR,
    TARGETS,
)
from granero.sinks.text import text_dump
from granero.sources.jdbc import read_back
from granero.sources.snapshots import SnapshotStore
from tests.helpers import bag, column


@pytest.fixture
def mart(spark, base):
    return ParquetMart(spark, base + "/mart")


def products(spark, codes):
    rows = spark.createDataFrame(
        [("1", code, "Plan", "2", "3", None, 0, "4") for code in codes],
        "RamoPlanId string, PlanTecnicoID string, PlanTecnico string, RamoComercialID string,"
        " ProductoComercialID string, ProductoComercial string, EstadoHabilitado int,"
        " SucursalRamoComercialID string",
    )
    return PRODUCTO.rows(rows)


def test_insert_ready_product(spark):
    row = products(spark, ["5.9"]).first().asDict()
    assert row == {
        "RamoPlanId": 1,
        "PlanTecnicoID": 5,
        "PlanTecnico": "Plan",
        "TipoProductoId": 0,
        "CategoriaId": 0,
        "RamoComercialID": 2,
        "ProductoComercialID": 3,
        "ProductoComercial": None,
        "SucursalRamoComercialID": 4,
        "EstadoHabilitado": 0,
        "ProductoTecnicoId": 0,
        "Moneda": None,
    }


def test_target_types(spark):
    typed = {field.name: field.dataType.simpleString() for field in PRODUCTO_COBERTURA.schema}
    assert typed == {
        "CoberturaId": "int",
        "TipoCoberturaId": "string",
        "ProductoId": "int",
        "Monto": "int",
        "Deducible": "int",
        "Variable": "int",
    }


def test_unwritten_table_is_empty(mart):
    assert mart.read(PRODUCTO).count() == 0
    assert mart.read(PRODUCTO).columns == [*PRODUCTO.columns, "ProductoId"]


def test_append_adds_rows_and_goes_on_numbering(spark, mart):
    mart.append(PRODUCTO, products(spark, ["5", "6"]))
    mart.append(PRODUCTO, products(spark, ["5", "6"]))
    stored = mart.read(PRODUCTO)
    assert sorted(column(stored, "ProductoId")) == [1, 2, 3, 4]
    assert sorted(column(stored, "PlanTecnicoID")) == [5, 5, 6, 6]


def test_batch_id_makes_a_rerun_replace_its_rows(spark, mart):
    mart.append(PRODUCTO, products(spark, ["1"]), batch_id="monday")
    mart.append(PRODUCTO, products(spark, ["5", "6"]), batch_id="tuesday")
    before = bag(mart.read(PRODUCTO))
    mart.append(PRODUCTO, products(spark, ["5", "6"]), batch_id="tuesday")
    assert bag(mart.read(PRODUCTO)) == before


def test_a_failed_rerun_leaves_the_old_batch(spark, mart):
    mart.append(PRODUCTO, products(spark, ["5", "6"]), batch_id="monday")
    before = bag(mart.read(PRODUCTO))
    with pytest.raises(Exception):
        mart.append(PRODUCTO, products(spark, ["5", "junk"]), batch_id="monday")
    links = [(1, None, 1, None, None, None)]
    mart.append(PRODUCTO_COBERTURA, spark.createDataFrame(links, PRODUCTO_COBERTURA.schema), "monday")
    broken = spark.range(1).select(
        F.raise_error(F.lit("no rows")).cast("int").alias("CoberturaId"),
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in PRODUCTO_COBERTURA.schema[1:]),
    )
    with pytest.raises(Exception):
        mart.append(PRODUCTO_COBERTURA, broken, "monday")
    assert bag(mart.read(PRODUCTO)) == before
    assert mart.read(PRODUCTO_COBERTURA).count() == 1


def test_a_replaced_middle_batch_keeps_its_ids(spark, mart):
    mart.append(PRODUCTO, products(spark, ["1", "2"]), batch_id="monday")
    mart.append(PRODUCTO, products(spark, ["3", "4"]), batch_id="tuesday")
    before = bag(mart.read(PRODUCTO))
    mart.append(PRODUCTO, products(spark, ["1", "2"]), batch_id="monday")
    assert bag(mart.read(PRODUCTO)) == before
    with pytest.raises(ValueError, match="later batch"):
        mart.append(PRODUCTO, products(spark, ["1", "2", "9"]), batch_id="monday")
    assert bag(mart.read(PRODUCTO)) == before
    mart.append(PRODUCTO, products(spark, ["3", "4", "9"]), batch_id="tuesday")
    assert sorted(column(mart.read(PRODUCTO), "ProductoId")) == [1, 2, 3, 4, 5]


def test_a_stale_upsert_fails(spark, base, mart):
    first = spark.createDataFrame([(1, 10, 5, "A")], CORREDOR.schema)
    second = spark.createDataFrame([(2, 20, 5, "B")], CORREDOR.schema)

    class Slow(ParquetMart):
        def _write(self, target, rows, batch_id):
            mart.upsert(CORREDOR, second)  # another load is faster
            return super()._write(target, rows, batch_id)

    with pytest.raises(StaleTable):
        Slow(spark, base + "/mart").upsert(CORREDOR, first)
    assert bag(mart.read(CORREDOR)) == bag(second.select(*CORREDOR.schema.names))


def test_overwrite(spark, mart):
    mart.append(PRODUCTO, products(spark, ["1", "2"]))
    old = mart.read(PRODUCTO)
    mart.overwrite(PRODUCTO, products(spark, ["7"]))
    assert [tuple(row)[-1] for row in mart.read(PRODUCTO).collect()] == [1]
    assert old.count() == 2


def test_upsert_twice_is_upsert_once(spark, mart):
    brokers = [(1, 10, 5, "A"), (1, 10, 6, "B"), (2, 20, 0, None)]
    rows = spark.createDataFrame(brokers, CORREDOR.schema)
    mart.upsert(CORREDOR, rows)
    once = bag(mart.read(CORREDOR))
    assert once == {(1, 6, 10, "B"): 1, (2, 0, 20, None): 1}
    mart.upsert(CORREDOR, rows)
    assert bag(mart.read(CORREDOR)) == once


def test_read_back(spark):
    stored = spark.createDataFrame(
        [(1, None, None, None, None, 6, 7, None, None, None, None, None, 9)],
        PRODUCTO.schema,
    )
    row = read_back(stored).first().asDict()
    assert row["RamoPlanID"] == 1 and row["PlanTecnicoID"] == 0 and row["ProductoId"] == 9
    assert row["PlanTecnico"] is None and row["Moneda"] is None
    assert len(row) == 13


def test_text_dump(spark, base):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    text_dump(rows.repartition(3), base + "/lines", files=1)
    lines = spark.read.text(base + "/lines")
    assert sorted(column(lines, "value")) == ['{"k":1,"v":"a"}', '{"k":2}']
    assert lines.select(F.input_file_name()).distinct().count() == 1


def test_load_twice(spark, base, mart, sf_dir):
    from checks.adapters import ADAPTERS, source_tables

    lazy = source_tables(spark, sf_dir)
    tables = {name: lazy[name] for name in ADAPTERS}
    store = SnapshotStore(spark, base + "/snapshots")
    load_mart(tables, mart, store, batch_id="one")
    first = {target.name: bag(mart.read(target)) for target in TARGETS}
    with pytest.raises(FileExistsError):
        load_mart(tables, mart, store)
    load_mart(tables, mart, store, if_exists="reuse", batch_id="one")
    assert {target.name: bag(mart.read(target)) for target in TARGETS} == first

    load_mart(tables, mart, store, if_exists="reuse", batch_id="two")
    sizes = {name: rows.total() for name, rows in first.items()}
    assert mart.read(PRODUCTO).count() == 2 * sizes["Producto"]
    assert mart.read(COBERTURA).count() == 2 * sizes["Cobertura"]
    # The second load links all stored products, those of the first included.
    assert mart.read(PRODUCTO_COBERTURA).count() == 3 * sizes["ProductoCobertura"]
    assert mart.read(PRODUCTO_CORREDOR).count() == 3 * sizes["ProductoCorredor"]
    assert bag(mart.read(CORREDOR)) == first["Corredor"]
